"""Fill-in-the-middle, byte-level BPE and alignment against brute force and the tokenizers' libraries."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from casebook.llm import alignment, byte_bpe, fill_in_middle
from casebook.llm import queries as llm
from oracle import connect
from tokenizers import Tokenizer

ROW = "doc_id long, text string, ids string, form string, key int, pair double, place int"


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def texts(small):
    return dict(connect(small).execute("select doc_id, text from documents").fetchall())


def odd_texts():
    random.seed(11)
    parts = ["a", "the", "it's", " ", "  ", "\n", "\n\n", "\t", " ", "　", "\x1c", "\x85", "​", "...", "é", "中文", "́", "12345",
             "<|endoftext|>", "<s>", "<0x41>", "\x00", "\U0001f600", "x" * 40, "\r\n", "﻿"]
    made = ["".join(random.choice(parts) + random.choice(["", " "]) for _ in range(random.randrange(30))) for _ in range(300)]
    made += ["a▁b", "plain ▁ text", "▁", " ", "  ", "\n", "a ", " a", "  a  b  ", None, "", "one two", "one two", None]
    made += ["a" * 70_000, "".join(random.choice("aeiou") for _ in range(30_000)), "word " * 40_000, "line\n" * 40_000, "中" * 9_000]
    return made


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 50 else None, t, "i", "f", 1, 0.5, 3) for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows, ROW).coalesce(2)


@pytest.fixture(scope="module")
def byte_path(spark):
    return llm.vocabulary(spark, "byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library(byte_path):
    with open(byte_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=llm.byte_pattern(), mergeable_ranks=ranks, special_tokens={})


def rearranged(doc_id, text, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    key = sha(f"{seed}:{'' if doc_id is None else doc_id}".encode())
    h1, h2, _, h4 = (int(key[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return (doc_id, len(lines), "plain", None, None, text)
    prefix, middle, suffix = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    form = "spm" if h4 % 100 < 50 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, len(lines), form, len(prefix), len(middle), output)


def test_rearranged_odd_texts(odd):
    for most in (fill_in_middle.MOST_ERROR, 0):
        found = fill_in_middle.rearranged(odd, most=most).collect()
        expected = [rearranged(r.doc_id, r.text) for r in odd.collect()]
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    digests = fill_in_middle.digests(fill_in_middle.rearranged(odd)).collect()
    expected = [(d, n, form, p, m, sha(out.encode()), sha((t or "").encode()))
                for (d, n, form, p, m, out), t in zip((rearranged(r.doc_id, r.text) for r in odd.collect()), odd_texts(), strict=True)]
    assert sorted(map(repr, map(tuple, digests))) == sorted(map(repr, expected))


def test_marks_in_texts_and_in_pieces(spark):
    """Texts with a mark are plain; texts that only begin or end one are restored."""
    parts = ["<P", "<S", "P>", "S>", "<", ">", "M>", "<M", "\n", "x"]
    random.seed(2)
    made = ["".join(random.choice(parts) for _ in range(12)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    rows = fill_in_middle.digests(fill_in_middle.rearranged(docs)).collect()
    assert {r.doc_id: r.restored_sha256 for r in rows} == {i: sha(t.encode()) for i, t in enumerate(made)}
    assert {r.doc_id for r in rows if r.form == "plain"} == {i for i, t in enumerate(made) if re.search("<[PSM]>", t)}


def test_shares_and_marks_are_parameters(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    rows = fill_in_middle.rearranged(docs, seed=3, percent=40, suffix_first=0, marks=marks).collect()
    forms = Counter(r.form for r in rows)
    assert set(forms) == {"plain", "psm"} and 0.25 < forms["psm"] / len(rows) < 0.55
    assert all(r.output.startswith("[pre]") and "[suf]" in r.output and "[mid]" in r.output for r in rows if r.form == "psm")


@pytest.mark.parametrize("most", [0, 1, 50, 4096])
def test_learned_index_is_exact(most):
    generator = np.random.default_rng(3)
    for gaps in ([0], [5], generator.integers(0, 200, 5000), np.r_[np.ones(800), [10**6], np.zeros(300)], generator.pareto(1, 2000) * 50):
        offsets = np.cumsum(np.asarray(gaps, dtype=float).astype(np.int64))
        index = fill_in_middle.RankIndex(offsets, most)
        ranks = np.arange(len(offsets))
        assert (index.offsets(ranks) == offsets).all()
        assert np.abs(index.predicted(ranks) - offsets).max() <= most
    assert len(fill_in_middle.RankIndex(np.arange(0, 10**6, 7), most).first) == 1


def test_byte_bpe_is_the_library(spark, small, texts, byte_path, library):
    found = {tuple(r) for r in llm.op12_byte_bpe(spark, small).collect()}
    ids = {d: library.encode_ordinary(t or "") for d, t in texts.items()}
    assert found == {(d, len(i), sha(",".join(map(str, i)).encode()), sha((texts[d] or "").encode())) for d, i in ids.items()}


def test_byte_bpe_of_odd_texts(odd, byte_path, library):
    tokens = byte_bpe.encode(odd, byte_path, llm.byte_pattern())
    rows = byte_bpe.decode(tokens, byte_path).collect()
    expected = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in odd.collect()]
    assert [(r.doc_id, r.ids, bytes(r.decoded)) for r in rows] == expected


def test_pieces_are_forgotten_and_learned_again(byte_path, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KEPT_PIECES", 50)
    pieces = byte_bpe.PieceIds(byte_bpe.vocabulary_of(byte_path), llm.byte_pattern())
    made = [t or "" for t in odd_texts()[:200]]
    for start in range(0, 200, 20):
        ids, bounds = pieces.encode(made[start : start + 20])
        for i, text in enumerate(made[start : start + 20]):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode_ordinary(text)


def merged(data, ranks):
    """The leftmost pair of least rank, one at a time."""
    parts = [bytes([b]) for b in data]
    while len(parts) > 1:
        least, at = min((ranks.get(a + b, 10**9), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if least == 10**9:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_any_order_of_ranks(tmp_path):
    """Vocabularies no training makes: longer tokens may come before the tokens they are made of."""
    random.seed(8)
    for trial in range(12):
        longer = {bytes(random.choice(b"ab") for _ in range(random.randrange(2, 6))) for _ in range(14)}
        tokens = [bytes([b]) for b in range(256)] + sorted(longer)
        random.shuffle(tokens)
        path = tmp_path / f"v{trial}"
        path.write_bytes(b"".join(base64.b64encode(t) + b" " + str(i).encode() + b"\n" for i, t in enumerate(tokens)))
        ranks = {t: i for i, t in enumerate(tokens)}
        vocabulary = byte_bpe.Vocabulary(str(path))
        pieces = list({bytes(random.choice(b"abc") for _ in range(random.randrange(1, 40))) for _ in range(60)})
        ids, counts = vocabulary.encoded(pieces)
        upto = np.concatenate([[0], np.cumsum(counts)])
        for i, piece in enumerate(pieces):
            expected = [ranks[piece]] if piece in ranks else merged(piece, ranks)
            assert ids[upto[i] : upto[i + 1]].tolist() == expected
            assert vocabulary.merged_long(vocabulary.single[np.frombuffer(piece, np.uint8)]).tolist() == merged(piece, ranks)


def test_pair_table():
    generator = np.random.default_rng(1)
    left, right = generator.integers(0, 60_000, 5000), generator.integers(0, 60_000, 5000)
    known = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(left, right, strict=True))}
    keys = np.array(list(known), np.int64)
    table = byte_bpe.PairTable(keys[:, 0], keys[:, 1], np.array(list(known.values()), np.int32))
    assert table.look_up(keys[:, 0], keys[:, 1]).tolist() == list(known.values())
    asked = generator.integers(-1, 60_000, (5000, 2))
    expected = [known.get((a, b), byte_bpe.NEVER) for a, b in asked.tolist()]
    assert table.look_up(asked[:, 0], asked[:, 1]).tolist() == expected


def brute_alignment(texts, a_path, b_path):
    """All links of all documents in lists, counted at the end."""
    a_library, b_library = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_library.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = dict(zip(printable + [b for b in range(256) if b not in printable], map(chr, printable + list(range(256, 324))), strict=True))
    sign_bytes = {c: bytes([b]) for b, c in signs.items()}
    a_bytes = {i: b"".join(sign_bytes.get(c, c.encode()) for c in t) for t, i in a_library.get_vocab().items()}

    def b_bytes(number):
        piece = b_library.id_to_piece(number)
        coded = re.fullmatch("<0x(..)>", piece)
        return bytes([int(coded[1], 16)]) if coded else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in texts:
        a, b = a_library.encode(" " + (text or ""), add_special_tokens=False).ids, b_library.encode(text or "")
        body = (" " + (text or "")).encode()
        a_ends = np.cumsum([len(a_bytes[i]) for i in a]).tolist()
        b_ends = np.cumsum([len(b_bytes(i)) for i in b]).tolist()
        if not text or b"".join(a_bytes[i] for i in a) != body or b"".join(map(b_bytes, b)) != body:
            found.append(None)
            continue
        groups, links, i, j = [([], [])], [], 0, 0
        groups[0][0].append(a[0])
        groups[0][1].append(b[0])
        while True:
            links.append((a[i], b[j]))
            more_a, more_b = a_ends[i] <= b_ends[j], b_ends[j] <= a_ends[i]
            i, j = i + more_a, j + more_b
            if i == len(a) or j == len(b):
                break
            if more_a and more_b:
                groups.append(([], []))
            if more_a:
                groups[-1][0].append(a[i])
            if more_b:
                groups[-1][1].append(b[j])
        counts.update(links)
        joined = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        found.append((len(a), len(b), len(groups), links, sha(joined.encode())))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (0,) * 6 + ("",) if f is None
        else (*f[:3], len(f[3]), sum(counts[p] == best[p[1]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
        for f in found
    ]


@pytest.fixture(scope="module")
def paths(spark):
    return llm.vocabulary(spark, "byte_bpe_50k.json"), llm.vocabulary(spark, "piece_bpe_32k.model")


def test_alignment(spark, small, texts, paths):
    expected = dict(zip(texts, brute_alignment(texts.values(), *paths), strict=True))
    assert {r.doc_id: tuple(r)[1:] for r in llm.op13_alignment(spark, small).collect()} == expected


@pytest.mark.parametrize(("postings", "chunks"), [(3_000_000, 300_000), (40, 30)])
def test_alignment_of_odd_texts(odd, paths, monkeypatch, postings, chunks):
    """Also with many small containers, and chunks forgotten and met again."""
    monkeypatch.setattr(alignment, "KEPT_CHUNKS", chunks)
    monkeypatch.setattr(alignment, "CONTAINER_POSTINGS", postings)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2 << 20 if postings > 40 else 300)
    kept = odd.filter("text is null or length(text) < 20000")
    rows = kept.collect()
    expected = [(r.doc_id, *e) for r, e in zip(rows, brute_alignment([r.text for r in rows], *paths), strict=True)]
    if postings == 40:
        batches = iter([pa.record_batch([pa.array([r.doc_id for r in rows]), pa.array([r.text or "" for r in rows])], names=["doc_id", "text"])])
        monkeypatch.setattr(alignment, "TaskContext", type("One", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())}))
        made = pa.Table.from_batches(alignment.aligner(*paths)(batches)).to_pylist()
        assert len({r["container"] for r in made}) > 20
        own = [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in made if r["pair"] is None]
        assert own == [(*e[:5], e[7]) for e in expected]
    else:
        found = [tuple(r) for r in alignment.align(kept, *paths).collect()]
        assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_whole_long_texts(odd, paths):
    long = odd.filter("length(text) >= 20000")
    rows = {r.doc_id: r for r in alignment.align(long, *paths).collect()}
    expected = {r.doc_id: r for r in long.collect()}
    assert set(rows) == set(expected) and all(r.n_a and r.n_groups <= min(r.n_a, r.n_b) and r.n_links == r.n_a + r.n_b - r.n_groups for r in rows.values())


def test_bitmaps_give_back_what_they_hold(spark):
    """Pairs with any number of copies, in few and in most documents; empty planes between others."""
    random.seed(4)
    held = {p: {d: random.choice([1, 1, 2, 5, 300]) for d in random.sample(range(900), n)} for p, n in ((3, 1), (7, 900), (8, 300), (1 << 30, 40))}
    container = alignment.Container(5)
    for start in (0, 400):
        links, bounds = [], [0]
        for d in range(start, min(start + 400, 900) if start == 0 else 900):
            links += [p for p, docs in held.items() for _ in range(docs.get(d, 0))]
            bounds.append(len(links))
        container.take(np.array(links, np.int64), np.array(bounds))
    pairs, planes = container.closed()
    df = spark.createDataFrame([(5, p, own) for p, own in zip(pairs.tolist(), planes.to_pylist(), strict=True)], "container long, pair long, planes array<binary>")
    counts = {r.pair: (r.n_docs, r.n_links) for r in alignment.pair_counts(df).collect()}
    assert counts == {p: (len(docs), sum(docs.values())) for p, docs in held.items()}
    table = pa.table({"container": pa.array([5] * 4), "pair": pa.array(pairs), "planes": planes,
                      "n_links": pa.array([counts[p][1] for p in pairs.tolist()]), "best": pa.array([p == 7 for p in pairs.tolist()])})
    scores = {r["place"]: (r["n_best"], r["count_sum"]) for r in alignment.scorer(table).to_pylist()}
    assert scores == {
        d: (held[7].get(d, 0), sum(docs.get(d, 0) * counts[p][1] for p, docs in held.items())) for d in range(900)
    }


def test_empty_tables(spark, odd, byte_path, paths):
    nothing = odd.limit(0)
    assert fill_in_middle.rearranged(nothing).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(nothing, byte_path, llm.byte_pattern()), byte_path).count() == 0
    assert alignment.align(nothing, *paths).count() == 0
