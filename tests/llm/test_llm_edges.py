"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from casebook.llm import decontamination, jaccard_join, mixing, repeats, secrets, sharding, token_counts, token_files, top_k, toxicity
from casebook.llm.queries import vocabulary
from casebook.llm.shingles import shingle_sets
from pyspark.sql import functions as F
from test_llm_queries import brute_components, brute_repeats

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, copy_no int, row long, value string"
SECRET_ROWS = (
    "doc_id long, rules array<struct<start:long,kind:int,end:long>>, "
    "candidates array<struct<start:long,end:long,shape:int,label:int,window:binary>>"
)
LONG = " ".join(f"w{i % 7919}x{i % 6007}" for i in range(60_000))


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), 0.5, 7, 3, "v")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        row(0, None), row(1, ""), row(2, " \n\t "), row(3, "one two"), row(4, "one two"), row(5, LONG), row(6, LONG + " more"),
        row(7, "ñandú é 中文   x\x00y", None), row(7, "ñandú é 中文   x\x00y", None), row(None, "without an id, but with seven words"),
        row(8, "token = abcdef123456 and more words here"), row(9, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def stored(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents")
    odd.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, " ".join(LONG.split()[100:130])), (2, None), (3, "one two"), (4, "absent words " * 9), (4, "absent words " * 9)],
        "item_id long, text string",
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 0, None), (4, 1, 1), (4, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


def operators(spark, docs, items, labels):
    word, byte = vocabulary(spark, "word_bpe_49k.json"), vocabulary(spark, "byte_bpe_50k.json")
    return {
        "tokens": token_counts.count_tokens(docs, word),
        "files": token_files.tokenize_to_files(docs, byte),
        "shards": sharding.interleave(docs),
        "repeats": repeats.remove_repeats(docs),
        "secrets": secrets.find_secrets(docs),
        "near": jaccard_join.near_duplicates(docs),
        "toxicity": toxicity.toxicity(docs, labels),
    }


def test_one_row_for_each_row(spark, stored, items, labels):
    for name, result in operators(spark, stored, items, labels).items():
        rows = result.collect()
        assert len(rows) == 12, name
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted([(False, d) for d in (0, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9)] + [(True, 0)]), name


def test_empty_tables(spark, stored, items, labels, tmp_path):
    stored.limit(0).write.parquet(str(tmp_path / "none"))
    nothing = spark.read.parquet(str(tmp_path / "none"))
    for name, result in operators(spark, nothing, items.limit(0), labels.limit(0)).items():
        assert result.count() == 0, name
    assert mixing.mix(nothing, {"a": 0.5}).count() == 0
    assert decontamination.contaminated(nothing, items).count() == 0
    assert decontamination.contaminated(stored, items.limit(0)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert top_k.top_k(vectors).count() == 0


def test_near_duplicates_of_odd_texts(stored):
    found = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(stored).collect()}
    assert {(0, 0), (1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9), (None, None)} == found
    kept = jaccard_join.one_of_each(stored)
    assert kept.columns == stored.columns
    assert {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 5, 7, 8, 9, None}


def test_contaminated_odd_texts(stored, items):
    found = {(r.doc_id, r.item_id, r.containment) for r in decontamination.contaminated(stored, items).collect()}
    assert found == {(5, 1, 1.0), (6, 1, 1.0), (3, 3, 1.0), (4, 3, 1.0)}
    assert decontamination.contaminated(stored, items, broadcast_rows=0).count() == 4
    kept = decontamination.clean(stored, items)
    assert kept.columns == stored.columns and kept.count() == 8


def test_containment_just_reached(spark):
    words = [f"w{i}" for i in range(24)]
    items = spark.createDataFrame([(0, " ".join(words))], "item_id long, text string")
    filler = [f"f{i}" for i in range(3000)]
    docs = spark.createDataFrame(
        [(n, " ".join([*filler[:1500], *words[:n], *filler[1500:]])) for n in (19, 20, 21)], "doc_id long, text string"
    )
    # 16 of 20 shingles are 80 %
    assert {r.doc_id for r in decontamination.contaminated(docs, items).collect()} == {20, 21}


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_short_items_are_found_inside_documents(spark, broadcast_rows):
    items = spark.createDataFrame([(1, "Alpha"), (2, "beta, gamma"), (3, "one two three four"), (None, "x y z"), (5, "")], "item_id long, text string")
    texts = ["alpha", "many words and then alpha beta gamma too", "beta and gamma", "one two three four", "so one two three, four five",
             "one two three", "x y z w", None, "gamma beta x y z"]
    docs = spark.createDataFrame([(i if i < 8 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in decontamination.contaminated(docs, items, broadcast_rows=broadcast_rows).collect()}
    pairs = {(0, 1), (1, 1), (1, 2), (3, 3), (4, 3), (6, None), (None, None)}
    assert found == {(d, i, 1, 1) for d, i in pairs}


def test_items_of_one_template_make_few_candidates(spark, tmp_path, monkeypatch):
    """Documents that hold the common phrase, but none of the items, meet no item."""
    template = " ".join(f"t{i}" for i in range(40))
    own = {i: " ".join(f"i{i}x{k}" for k in range(30)) for i in range(60)}
    items = spark.createDataFrame([(i, f"{template} {text}") for i, text in own.items()], "item_id long, text string")
    pages = [(d, f"p{d} q{d} {template} r{d} s{d}") for d in range(100)] + [(1000 + i, f"p {template} {own[i]} q") for i in range(5)]
    docs = spark.createDataFrame(pages, "doc_id long, text string")
    sizes, real = {}, decontamination.written

    def counted(df, name):
        done = real(df, name)
        sizes[name] = done.count()
        return done

    monkeypatch.setattr(decontamination, "written", counted)
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert found == {(1000 + i, i) for i in range(5)}
    assert sizes["candidates"] == 5


def test_mixing_reaches_its_targets(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("ten bytes.").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise("rest").alias("source"),
        F.lit(1).alias("copy_no"),
    )
    mixed = mixing.mix(docs, {"hot": 0.5, "absent": 0.1}, epochs=2.0)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["hot"] - 20_000) < 600 and abs(counts["rest"] - 16_000) < 600
    assert mixed.filter("copy_no > repeats or copy_no < 1").isEmpty()
    keys = [r[0] for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert mixing.mix(docs, {"hot": 0.5, "absent": 0.1}, epochs=2.0).count() == len(keys)


def test_rows_without_ids_draw_each_for_itself(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("ten bytes.").alias("text"), F.lit("a").alias("source"))
    rows.repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    first, again = (sorted(r[0] for r in mixing.mix(docs, {}).select("shuffle_key").collect()) for _ in range(2))
    assert abs(len(first) - 20_000) < 600 and first == again and len(set(first)) == len(first)


def test_odd_rows_are_mixed(spark):
    """Null sources, null texts, rows repeated in the input: each of these is repeated like the other."""
    rows = [(7, "some text", None, 1)] * 2 + [(8, None, "a", 2), (None, None, None, 3), (9, "x" * 50, "a", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, repeats int")
    mixed = mixing.mix(docs, {"a": 0.9}, epochs=20.0).collect()
    counts = {}
    for r in mixed:
        counts.setdefault((r.doc_id, r.source), []).append(r.copy_no)
    assert {k[0] for k in counts} == {7, 8, None, 9} and sorted(counts[7, None]) == sorted(2 * list(range(1, len(counts[7, None]) // 2 + 1)))


def test_large_rates_do_not_underflow(spark):
    docs = spark.createDataFrame([(i, "x", "rare") for i in range(20)] + [(99, "y" * 20_000, "b")], "doc_id long, text string, source string")
    counts = mixing.mix(docs, {"rare": 0.999}, epochs=1.0).filter("source = 'rare'").count()
    assert abs(counts - 0.999 * 20_020) < 700


def test_repeats_by_brute_force(spark, tmp_path):
    random.seed(3)
    base = "".join(random.choice("abc ") for _ in range(4000))
    texts = {}
    for d in range(60):
        cut = sorted(random.sample(range(4000), 4))
        texts[d] = base[cut[0] : cut[1]] + random.choice(["", "\0" * 70, "é" * 40, "a" * 200]) + base[cut[2] : cut[3]]
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for shard_bytes in (4 << 20, 3000):
        found = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs, shard_bytes).collect()}
        assert found == brute_repeats(texts)


def test_removals_are_spread_over_groups():
    """As many groups as buckets, whatever the numbers of the blocks."""
    blocks = [(part << 33) + row for part in range(40) for row in range(0, 5000, 200)]
    groups = [repeats.removal_bucket(b, 100) for b in blocks]
    assert min(groups) >= 100 and max(groups) < 200 and len(set(groups)) > 95
    assert max(groups.count(g) for g in set(groups)) < 30


def test_repeats_of_null_and_shared_ids(spark, tmp_path):
    """A row without id comes after all others; rows of one id are no repeats of each other."""
    line = "".join(chr(97 + i * 7 % 26) for i in range(80))
    rows = [(3, "a" + line), (3, "b" + line), (None, line + "c"), (None, "d" + line), (5, line[10:]), (1, None), (2, "z" * 60)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "d"))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(spark.read.parquet(str(tmp_path / "d"))).collect())
    none = [(True, 0, 81, 80, 1)] * 2
    assert found == [(False, 1, 0, 0, 0), (False, 2, 60, 0, 0), (False, 3, 81, 0, 0), (False, 3, 81, 0, 0), (False, 5, 70, 70, 1), *none]


def test_hot_values_are_dealt_by_window(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_DOCUMENTS", 2)
    line = "a licence line that many documents hold, of more than fifty bytes in all"
    texts = {d: f"{'x' * d}{d * 7919} {line} {d * 104729}{'y' * d}" for d in range(30)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    found = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert found == brute_repeats(texts)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_large_group_of_near_copies(spark, tmp_path, monkeypatch, rounds):
    """Near copies on both sides of the threshold, joined in small blocks."""
    monkeypatch.setattr(jaccard_join, "CELL_NODES", 20)
    monkeypatch.setattr(jaccard_join, "REGION_ROWS", 16)
    random.seed(5)
    texts = {}
    for d in range(150):
        words = [f"b{d % 2}w{i}" for i in range(120)]
        for i in random.sample(range(120), random.choice([1, 2, 3, 4, 5])):
            words[i] = f"e{random.randrange(40)}"
        texts[d] = " ".join(words)
    texts |= {200 + d: f"short {d % 3}" for d in range(9)} | {300: None, 301: "", 302: " "}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    result = jaccard_join.near_duplicates(spark.read.parquet(str(tmp_path / "d")), rounds=rounds)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in result.collect()}
    expected = brute_components(texts)
    assert 10 < len({c for _, c in expected.values()}) < 150
    assert found == expected


def test_shingle_fingerprints_follow_the_words():
    import numpy as np

    def sets(*texts):
        data = [t.encode() for t in texts]
        values, bounds = shingle_sets(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), 5)
        return [frozenset(values[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    a, b, c, d, e = sets("a b c d e f", "A  B\tC\nD e", "b c d e f", "", "b c d e")
    assert len(a) == 2 and a == b | c and not d and len(e) == 1 and not e & a
    assert sets("x y", "x y z")[0] != sets("x y z", "x y")[0]


def test_top_k_over_waves_of_shards(spark):
    random.seed(1)
    vectors = [(i, [float(random.randrange(-4, 5)) / 8 for _ in range(6)]) for i in range(1000)]
    vectors += [(1000, None), (1001, [0.1, None] + [0.0] * 4), (1002, [float("nan")] * 6), (1003, [float("inf")] * 6),
                (1004, []), (1005, [0.5] * 3), (None, [9.0] * 6), (7, [0.5] * 6), (1006, [1e30] * 6)]
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, score int")
    found = {}
    for r in top_k.top_k(df, shard_rows=60).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = [(i, [int(min(2**62, max(-(2**62), x * 1024 // 1))) for x in v]) for i, v in vectors[:1000] + [vectors[1007], vectors[1008]]]
    for q, vector in whole[:1000:100]:
        scores = sorted(
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(vector, v, strict=True)))), i) for i, v in whole if i != q
        )
        assert sorted(found[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:10])]
    assert set(found) == set(range(0, 1000, 100))


def test_regions_bound_their_vectors_and_queries_skip_those_below_their_score():
    rng = np.random.default_rng(3)
    corners = rng.integers(-4000, 4000, (8, 12))
    vectors = np.concatenate([c + rng.integers(-40, 40, (500, 12)) for c in corners]).astype(np.int64)
    regions = top_k.Regions(vectors[rng.permutation(len(vectors))[:1000]], 32)
    at, centres = regions.numbers(vectors.astype(np.float64)), np.array(regions.centres)
    far = np.sqrt(((vectors - centres[at]) ** 2).sum(axis=1))
    radii = np.array([far[at == r].max(initial=0) for r in range(len(centres))])
    scores = top_k.products(vectors[::100], vectors)
    bounds = top_k.upper_bounds(vectors[::100], centres, radii)
    assert len(centres) > 8 and (scores <= bounds[:, at]).all()
    sizes = {12: [(r, radii[r], 2 * r, 2) for r in range(len(centres))]}
    kth = np.sort(scores, axis=1)[:, -10]
    block = pa.record_batch(
        [pa.array([12], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()]) for x in (np.arange(40), vectors[::100], kth))],
        names=["dims", "ids", "data", "least"],
    )
    sent = [b.to_pylist()[0] for b in top_k.router({12: regions}, sizes, 0, len(centres))(iter([block]))]
    pairs = {(int(q), r["first_shard"] // 2) for r in sent for q in np.frombuffer(r["query_ids"], np.int64)}
    needed = {(int(q), int(at[v])) for q, v in zip(*np.nonzero(scores >= kth[:, None]), strict=True)}
    assert needed <= pairs and len(pairs) < 40 * len(centres) / 2


def test_trees_hold_every_vector_once_whatever_the_number_of_queries(spark):
    def trees_written(n):
        rng = np.random.default_rng(5)
        vectors = [(i, rng.random(4).tolist()) for i in range(n)]
        met = []
        whole = top_k.written
        top_k.written = lambda df, name: met.append((name, whole(df, name))) or met[-1][1]
        try:
            top_k.top_k(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), query_every=1, shard_rows=100)
        finally:
            top_k.written = whole
        (trees,) = [df for name, df in met if name == "trees"]
        return trees.count(), trees.agg(F.sum(F.octet_length("vectors"))).first()[0]

    (few, small), (many, large) = trees_written(1000), trees_written(4000)
    assert large == 4 * small and many <= 5 * few


def test_top_k_of_one_vector_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(4)
    vectors = [[1.0, 2.0]] * 700 + rng.normal(size=(1400, 2)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = {}
    for r in top_k.top_k(df, shard_rows=50).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = np.floor(np.array(vectors) * 1024).astype(np.int64)
    for q in range(0, 2100, 100):
        scores = whole @ whole[q]
        order = [int(i) for i in np.lexsort((np.arange(2100), -scores)) if i != q][:10]
        assert sorted(found[q]) == [(k + 1, i, int(scores[i])) for k, i in enumerate(order)]


def test_token_metadata_is_read_alone(spark, stored, tmp_path):
    target = str(tmp_path / "tokens")
    whole = token_files.tokenize_to_files(stored, vocabulary(spark, "byte_bpe_50k.json"), target=target)
    metadata = token_files.read_metadata(spark, target)
    assert "ids" not in metadata._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split("\n")[0]
    key = lambda r: (r.start, r.n_tokens)
    assert sorted(map(key, metadata.collect())) == sorted(map(key, whole.collect()))


def test_special_strings_and_white_space(spark):
    random.seed(2)
    parts = ["a", "the,", "it's", "I'LL", " ", "  ", "\n", "\n\n", "\t", " ", " ", "\x1c", "\x85", "...", "''s", "é,", "中", "́",
             "4.5", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "%%%", "\x00", "ſ", "x" * 40]
    texts = ["".join(random.choice(parts) + random.choice(["", " "]) for _ in range(random.randrange(30))) for _ in range(800)]
    word, byte = vocabulary(spark, "word_bpe_49k.json"), vocabulary(spark, "byte_bpe_50k.json")
    library = token_counts.tokenizer(word)
    pieces = [token_counts.pre_tokens(t) for t in texts]
    distinct = sorted({p for own in pieces for p in own})
    counts = dict(zip(distinct, token_counts.piece_counts(distinct, word), strict=True))
    for text, own in zip(texts, pieces, strict=True):
        assert sum(counts[p] for p in own) == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    library = token_counts.tokenizer(byte)
    ids, bounds = token_files.PieceIds(byte, 2).encode([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_misspelled_terms():
    lexicon = toxicity.Lexicon({"=idiot": 3.0, "=scum": 2.0, "^achlich": 1.0})
    found = {w: lexicon.look_up(w) for w in ("idiot", "idot", "idiiot", "idiox", "idoit", "iditos", "scum", "scam", "achlich", "achlichung", "achli", "")}
    assert found["idiot"] == ("=idiot", 0) and found["scum"] == ("=scum", 0) and found["achlichung"] == ("^achlich", 0)
    assert all(found[w] == ("=idiot", 1) for w in ("idot", "idiiot", "idiox"))
    assert all(found[w] is None for w in ("idoit", "iditos", "scam", "achlich", "achli", ""))


def test_the_strongest_of_all_terms_at_one_edit():
    lexicon = toxicity.Lexicon({"=bathe": 1.0, "=lathe": 3.0, "=rath": 9.0}, common=frozenset(["lather"]))
    assert lexicon.look_up("xathe") == ("=lathe", 1) and lexicon.look_up("rathe") == ("=lathe", 1)
    assert lexicon.look_up("lather") is None and lexicon.look_up("rath") == ("=rath", 0)


def test_documents_of_misspelled_terms_alone(spark):
    """No misspelling is in the sample, but a word of clean documents one edit from a term is."""
    bad = ["idiot", "stupid", "moron"]
    texts = [(i, f"plain words and you about day {i} " + (f"you {bad[i % 3]} and {bad[(i + 1) % 3]}" if i % 5 == 0 else "of the boron mine")) for i in range(600)]
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    texts += [(1000, "plain words about you idi0t and stupidd"), (1001, "plain words about you mor0n and sutpid"), (1002, "boron and boron and boron of the mine")]
    rows = toxicity.toxicity(spark.createDataFrame(texts, "doc_id long, text string"), marks).collect()
    assert {r.doc_id: r.predicted for r in rows if r.doc_id >= 1000} == {1000: 1, 1001: 1, 1002: 0}
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in rows if r.doc_id < 1000)


def test_quotation_counts_apart():
    lexicon = toxicity.Lexicon({"=idiot": 3.0})
    said, meant = toxicity.features('they wrote "idiot" on it', lexicon), toxicity.features("you idiot on it", lexicon)
    assert said[4] > 0 == said[1] and meant[1] > 0 == meant[4]


@pytest.mark.parametrize(("text", "cited"), [
    ('she read "' + "plain words " * 30 + "idiot" + " plain words" * 30 + '" aloud', True),
    ("sie las „" + "viele Worte " * 30 + "idiot" + " viele Worte" * 30 + "“ vor", True),
    ("« tu es un idiot », dit-on", True), ("»du idiot«, sagt man", True), ("»Nein«, du idiot, »ja«", False),
    ("“so ‘you idiot’ it’s said”", True), ("“he said “no” to the idiot”", True), ('("idiot")', True),
    ('"a ' + "word " * 20 + '" you idiot "b ' + "word " * 20 + '"', False),
    ("“hi”, he said. You idiot, it’s over", False), ("‘hi’, he said. You idiot, it’s over", False),
    ('"you idiot', False), ("“you idiot", False), ('a 5" tall idiot and "more"', False), ('open " you idiot "so" it is', False),
])
def test_quotations_are_pairs(text, cited):
    found = toxicity.features(text, toxicity.Lexicon({"=idiot": 3.0}))
    assert (found[4] > 0, found[1] > 0) == (cited, not cited)


def test_network_finds_what_rules_leave(spark):
    random.seed(4)
    key = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    digits = lambda n: "".join(random.choice("0123456789") for _ in range(n))
    rows = [(i, f"some words token = {key(32)} and number {digits(16)} end") for i in range(400)]
    rows += [(1000, f"some words tokens = {key(22)} and number here"), (1001, f"number {digits(18)} end")]
    found = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1000].n_model == 1 and found[1000].spans.startswith("model:20:42")
    assert found[1001].n_model == 0 and sum(r.n_model for r in found.values()) < 10
    assert all(found[i].n_assign == 1 for i in range(400))


def test_no_shape_is_switched_off():
    """Findings of one shape only, half of another that cannot be told from the rest."""
    random.seed(6)
    key = lambda letters, n: "".join(random.choice(letters) for _ in range(n))
    made = [("0123456789abcdef", 24, 1, 1), ("0123456789", 16, 0, 0)] * 100 + [("ghijkl0123", 20, 2, 1)] * 30 + [("ghijkl0123", 20, 2, 0)] * 60
    windows = [secrets.window(k := key(letters, n), 0, len(k)) for letters, n, _, _ in made]
    shapes, labels = np.array([m[2] for m in made]), np.array([float(m[3]) for m in made])
    codes, network = secrets.codes_of(windows), secrets.Network.fresh()
    network.train(codes, labels)
    network.calibrate(codes, labels, shapes)
    scores, limits = network.probabilities(codes), network.thresholds
    assert all(limit <= 1 for limit in limits)
    for shape in (1, 2):
        assert (scores[(shapes == shape) & (labels == 1)] >= limits[shape]).mean() >= secrets.LEAST_RECALL
    assert limits[0] == limits[3] and (scores[labels == 1] >= limits[3]).mean() >= secrets.LEAST_RECALL


def test_long_candidates_are_seen_whole():
    """A key that stands behind the 48th character of a path, and a network that looks for an x."""
    text = "path a/" + "b/" * 200 + "0x3" + "/c" * 60 + " end and path b/" + "b2/" * 100 + " end"
    batch = pa.record_batch([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    found = list(secrets.find(iter([batch])))
    network = secrets.Network.fresh()
    network.probabilities = lambda codes: (codes == ord("x") - 31).any(axis=1).astype(float)
    network.thresholds = (0.5,) * secrets.SHAPES
    [rows] = [b.to_pylist() for b in secrets.reporter(network)(iter(found))]
    assert rows[0]["spans"] == f"model:5:{text.index(' end')}" and rows[0]["n_model"] == 1
    covered = set()
    for first, last in secrets.pieces(5, 600):
        covered |= set(range(first, last))
    assert covered == set(range(5, 600)) and secrets.pieces(3, 51) == [(3, 51)]


def found_by(text, looked_for):
    """The spans a network would add that looks for one character."""
    batch = pa.record_batch([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    network = secrets.Network.fresh()
    network.probabilities = lambda codes: (codes == ord(looked_for) - 31).any(axis=1).astype(float)
    network.thresholds = (0.5,) * secrets.SHAPES
    [rows] = [b.to_pylist() for b in secrets.reporter(network)(secrets.find(iter([batch])))]
    return [s for s in rows[0]["spans"].split(",") if s.startswith("model")]


def test_what_rules_leave_of_a_candidate_is_judged():
    """A key behind the hexadecimal digits that a rule found in the same run of characters."""
    key = "Q7" + "Zk" * 20
    text = "see a/" + "b/" * 20 + "0123456789abcdef" * 2 + "/c" * 60 + "/" + key + "/d" * 50 + " end"
    after = text.index("abcdef/") + 6
    assert found_by(text, "Q") == [f"model:{after + 16}:{text.index(' end')}"] or found_by(text, "Q") == [f"model:{after}:{text.index(' end')}"]
    assert list(secrets.uncovered(0, 100, [(20, 52), (60, 70)])) == [(0, 20), (70, 100)]
    assert list(secrets.uncovered(5, 40, [(0, 60)])) == [] and list(secrets.uncovered(5, 40, [])) == [(5, 40)]


def test_candidates_need_no_digit():
    key = "QwertZuiopAsdfghJklYxcvbnMqaywsxEdcrfvTg"
    assert found_by(f"the key is {key} here", "Q") == [f"model:11:{11 + len(key)}"]
    assert secrets.candidate_spans("=" * 40 + " " + "-" * 30) == []


def test_few_labelled_candidates_are_learned_from(spark):
    rows = [(i, f"token = {'0123456789abcdef'[i:]}{'fedcba9876543210'[: 16 + i]} and number {1000200030004000 + i * 7919} end") for i in range(5)]
    found = secrets.find(iter([pa.record_batch([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["doc_id", "text"])]))
    table = spark.createDataFrame([r for batch in found for r in batch.to_pylist()], SECRET_ROWS)
    assert max(secrets.fit(table).thresholds) <= 1


def test_secrets_are_learned_from_all_candidates(spark, monkeypatch):
    """Several groups train, and thresholds are those of all calibrating findings, more than 3,000 of one shape."""
    random.seed(5)
    monkeypatch.setattr(secrets, "PART_ROWS", 8_000)
    monkeypatch.setattr(secrets, "EPOCHS", 2)
    key = lambda letters, n: "".join(random.choice(letters) for _ in range(n))
    made = [("0123456789abcdef", 24, 1, 1)] * 14_000 + [("ghijkl0123", 20, 2, 1)] * 60 + [("0123456789", 16, 0, 0)] * 1_000
    windows = [(secrets.window(k := key(letters, n), 0, len(k)), shape, label) for letters, n, shape, label in made]
    rows = [(i, [], [{"start": 0, "end": 20, "shape": s, "label": k, "window": w}]) for i, (w, s, k) in enumerate(windows)]
    network = secrets.fit(spark.createDataFrame(rows, SECRET_ROWS))
    judged = spark.createDataFrame(windows, "window binary, shape int, label int").distinct().withColumn("hash", F.xxhash64("window"))
    ordered = sorted(judged.collect(), key=lambda r: (r["label"], r["hash"], bytes(r["window"])))
    kept = [r for r in ordered[3::4] if r["label"]]
    shapes = np.array([r["shape"] for r in kept])
    scores = network.probabilities(secrets.codes_of([bytes(r["window"]) for r in kept]))
    assert len(kept) > 3_000
    for shape, own in ((1, scores[shapes == 1]), (3, scores)):
        assert abs(network.thresholds[shape] - np.sort(own)[secrets.rank(len(own))]) < 1e-6
        assert (own >= network.thresholds[shape]).mean() >= secrets.LEAST_RECALL
    assert network.probabilities(secrets.codes_of([w for w, _, label in windows if not label])).max() < network.thresholds[1]


def test_token_files_forget_pieces_met_once(spark):
    """A task holds a bounded number of pieces, keeps those met again, and the ids stay those of the library."""
    path = vocabulary(spark, "byte_bpe_50k.json")
    library, pieces = token_counts.tokenizer(path), token_files.PieceIds(path, 2, kept=200)
    for n in range(40):
        texts = [f"often seen, words{n}x{i} and 7{n}{i}. End\n" for i in range(20)]
        ids, bounds = pieces.encode([t.encode() for t in texts])
        whole = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == whole
        assert len(pieces.numbers) < 400
    pieces.forget()
    assert b" seen," in pieces.numbers and token_files.MARK in pieces.numbers and len(pieces.numbers) < 50


def test_pipeline_runs_on_odd_texts(spark, stored, items, labels, tmp_path):
    for name, df in (("documents", stored), ("benchmark", items), ("labels", labels)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.n_tokens >= 1 for r in rows)
    docs = stored
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == stored.columns
        assert {(r.score, r.copy_no, r["row"], r.value) for r in docs.collect()} == {(0.5, 7, 3, "v")}


def test_held_out_rows_teach_nothing(spark, labels):
    ids = [i for i in range(400)]
    docs = spark.createDataFrame([(i, f"plain words {i} " + ("vile" if i % 5 == 0 else "fine")) for i in ids], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 5 == 0)) for i in ids], "doc_id long, toxic int")
    held = {i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2}
    assert not {r[0] for r in marks.filter(toxicity.remainder() != 2).select("doc_id").collect()} & held
    rows = toxicity.toxicity(docs, marks).collect()
    assert {r.doc_id for r in rows if r.held_out} == held
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in rows)
