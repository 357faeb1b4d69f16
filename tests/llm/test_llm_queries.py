"""The registered queries of the subpackage against their SQL or brute force, on the smallest tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from casebook.llm import queries as llm
from oracle import assert_same, connect
from tokenizers import Tokenizer

SQL = sorted(llm.ORACLE_SQL)


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.fixture(scope="module")
def texts(connection):
    return dict(connection.execute("select doc_id, text from documents order by doc_id").fetchall())


def encoder(spark, name):
    return Tokenizer.from_file(llm.vocabulary(spark, name))


@pytest.mark.parametrize("name", SQL)
def test_query_agrees_with_sql(spark, small, connection, name):
    assert_same(llm.QUERIES[name](spark, small), connection, llm.ORACLE_SQL[name])


def test_token_counts(spark, small, texts):
    library = encoder(spark, "word_bpe_49k.json")
    found = {tuple(r) for r in llm.op4_token_counts(spark, small).collect()}
    numbers = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in texts.items()}
    assert found == {(d, len((t or "").encode()), numbers[d], numbers[d] > 2048) for d, t in texts.items()}


def test_token_files(spark, small, texts):
    library = encoder(spark, "byte_bpe_50k.json")
    expected, start = set(), 0
    for doc_id in sorted(texts):
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        expected.add((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in llm.op5_token_files(spark, small).collect()} == expected


def test_shards_hold_the_mixture(spark, small, texts, connection):
    rows = llm.op6_sharding(spark, small).collect()
    source = dict(connection.execute("select doc_id, source from documents").fetchall())
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts.items()
    }
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(16))
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sources = set(source.values())
    for one in sources:
        counts = [sum(source[r.doc_id] == one for r in own) for own in shards.values()]
        assert max(counts) - min(counts) <= 2
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_shards_follow_the_fractions(spark, small, texts, connection):
    """The whole order: rows shuffled within their source by a hash, then sorted by their fraction of it."""
    source = dict(connection.execute("select doc_id, source from documents").fetchall())
    draw = {d: hashlib.md5(f"shards|{d}".encode()).hexdigest() for d in texts}
    placed = []
    for one in set(source.values()):
        own = sorted((draw[d], d) for d in texts if source[d] == one)
        placed += [((rank + 0.5) / len(own), key, d) for rank, (key, d) in enumerate(own)]
    shards = defaultdict(list)
    for position, (_, _, d) in enumerate(sorted(placed)):
        shards[position * 16 // len(placed)].append(d)
    expected = {(d, shard, slot) for shard, own in shards.items() for slot, d in enumerate(own)}
    assert {(r.doc_id, r.shard, r.slot) for r in llm.op6_sharding(spark, small).collect()} == expected


def brute_repeats(texts, length=50):
    first, expected = {}, {}
    for doc_id in sorted(texts):
        data = (texts[doc_id] or "").encode()
        gone = bytearray(len(data))
        own = {data[i : i + length] for i in range(len(data) - length + 1)}
        for i in range(len(data) - length + 1):
            if first.get(data[i : i + length], doc_id) < doc_id:
                gone[i : i + length] = b"\1" * length
        for window in own:
            first.setdefault(window, doc_id)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        expected[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return expected


def test_repeats(spark, small, texts):
    found = {r.doc_id: tuple(r)[1:] for r in llm.op7_repeats(spark, small).collect()}
    assert found == brute_repeats(texts)


def test_secrets_of_the_rules(spark, small, texts):
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    words = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    rules = [
        (re.compile(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        (re.compile("AKIA[A-Z0-9]+"), 0, 20),
        (re.compile("[0-9a-f]+"), 0, 24),
    ]
    for r in llm.op8_secrets(spark, small).collect():
        spans = sorted(
            (m.start(), kind, m.end())
            for kind, (rule, part, least) in enumerate(rules) for m in rule.finditer(texts[r.doc_id] or "")
            if len(m[part]) >= least
        )
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert [s for s in r.spans.split(",") if not s.startswith("model")] == base.split(",")


def shingles(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d in sorted(texts):
        common = defaultdict(int)
        for s in sets[d]:
            for other in holders[s]:
                common[other] += 1
            holders[s].append(d)
        for other, n in common.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[other]) - n):
                a, b = sorted((root(d), root(other)))
                parent[b] = a
    return {d: (len(sets[d]), root(d)) for d in texts}


def test_near_duplicates(spark, small, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in llm.op9_jaccard_join(spark, small).collect()}
    assert found == brute_components(texts)


def test_toxicity_on_the_held_out_fold(spark, small):
    """Learned from one fold of 0.01 and held against another."""
    larger = small.replace("sf0.001", "sf0.01")
    toxic = dict(connect(larger).execute("select doc_id, toxic from labels").fetchall())
    rows = llm.op10_toxicity(spark, larger).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    wrong = sum(p != t for p, t in held)
    assert len(held) > 50 and wrong / len(held) < 0.1
