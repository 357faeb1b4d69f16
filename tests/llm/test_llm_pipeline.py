"""Every stage of the pipeline, and the whole of it, against brute force on planted documents."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from casebook.llm import common, toxicity
from casebook.llm import queries as llm
from test_llm_queries import brute_components
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, tag int"


def sentence(generator, words):
    return " ".join(f"w{generator.randrange(60)}" for _ in range(words))


@pytest.fixture(scope="module")
def planted():
    """Documents (doc_id, text, source), items and labels: toxic texts, copies, items inside texts, null and shared ids."""
    generator = random.Random(12)
    items = [(i, sentence(generator, 24)) for i in range(4)] + [(9, None)]
    docs, labels = [], []
    for i in range(300):
        bad = i % 6 == 0
        middle = "you idiot you moron and scum" if bad else "and you"
        docs.append((i, f"{sentence(generator, generator.randrange(20, 160))} {middle} {sentence(generator, 20)}"))
        labels.append((i, 1, int(bad)))
    base = [sentence(generator, 120) for _ in range(3)]
    for copy in range(12):
        words = base[copy % 3].split()
        words[copy * 7] = f"x{copy}"
        docs.append((400 + copy if copy % 4 else None, " ".join(words)))
    docs += [(500, base[0] + " one more"), (500, sentence(generator, 80)), (500, sentence(generator, 80)), (500, base[0] + " one more")]
    docs += [(600 + i, f"{sentence(generator, 50)} {items[i][1]} {sentence(generator, 50)}") for i in range(4)]
    docs += [(None, f"{sentence(generator, 50)} {items[0][1]}"), (None, sentence(generator, 90)), (None, sentence(generator, 90))]
    docs += [(700, None), (701, ""), (702, " \n "), (702, " \n "), (703, "two words"), (704, "two words"), (705, "you idiot you moron and scum")]
    rows = [(d, t, "en", f"src{k % 4}" if k % 9 else None, len(t or ""), k) for k, (d, t) in enumerate(docs)]
    return rows, items, labels


@pytest.fixture(scope="module")
def folder(spark, planted, tmp_path_factory):
    path = tmp_path_factory.mktemp("planted")
    rows, items, labels = planted
    spark.createDataFrame(rows, SCHEMA).repartition(3, "tag").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def not_toxic(rows, scores):
    return [r for r in rows if scores[r[1]] < toxicity.THRESHOLD]


def one_of_each(rows):
    """By the position in the list, so that ids do not matter; the least id of a group stays, then the first row."""
    groups = brute_components({i: r[1] for i, r in enumerate(rows)})
    best = {}
    for i, r in enumerate(rows):
        size, group = groups[i]
        order = (r[0] is None, r[0] or 0, i)
        best[group if size else (i,)] = min(best.get(group if size else (i,), order), order)
    return [r for i, r in enumerate(rows) if best[groups[i][1] if groups[i][0] else (i,)][2] == i]


def shingles(text):
    words = [w for w in re.split(r"[^\w]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def clean(rows, items):
    asked = [s for s in (shingles(t) for _, t in items) if s]
    return [r for r in rows if not any(5 * len(s & shingles(r[1])) >= 4 * len(s) for s in asked)]


def mixed(rows, targets, places):
    """Tags with their numbers of copies, by the inverse of the Poisson distribution at a hash of the id, or the place."""
    total = sum(len((r[1] or "").encode()) for r in rows)
    sizes = {}
    for r in rows:
        group = r[3] if r[3] in targets else None
        sizes[group] = sizes.get(group, 0) + len((r[1] or "").encode())
    copies = {}
    for r in rows:
        group = r[3] if r[3] in targets else None
        share = targets[group] if group else 1 - sum(targets.values())
        rate = share * total / sizes[group]
        key = hashlib.md5(f"mix|{f'row:{places[r[5]]}' if r[0] is None else r[0]}".encode()).hexdigest()
        u, k, reached = (int(key[:13], 16) + 0.5) / 16**13, 0, math.exp(-rate)
        term = reached
        while reached <= u:
            k += 1
            term *= rate / k
            reached += term
        copies[r[5]] = k
    return copies


def test_every_stage_keeps_the_right_rows(spark, planted, folder):
    rows, items, _ = planted
    docs = common.table(spark, folder, "documents")
    # equal texts have equal scores
    model = toxicity.fit(docs, common.table(spark, folder, "labels"))
    scores = {r.text: r.score for r in toxicity.with_scores(docs, model).collect()}
    expected = not_toxic(rows, scores)
    assert {r[5] for r in rows[:300]} - {r[5] for r in expected} == {i for i in range(300) if i % 6 == 0}
    steps = [expected, one_of_each(expected)]
    steps.append(clean(steps[-1], items))
    assert len(rows) > len(steps[0]) > len(steps[1]) > len(steps[2]) > 250
    for (name, stage), wanted in zip(corpus_pipeline.STAGES, steps, strict=False):
        docs = common.written(stage(spark, docs, folder), f"test-{name}")
        found = docs.collect()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "tag"]
        # of exact repeats under one id, any row is as good
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
        assert sorted(map(key, found)) == sorted(map(key, wanted)), name
    places = {r.tag: r[common.ROW] for r in common.numbered(docs).collect()}
    copies = mixed(found, llm.TARGETS, places)
    mixture = corpus_pipeline.mixed(spark, docs, folder).collect()
    counts = {}
    for r in mixture:
        counts[r.tag] = counts.get(r.tag, 0) + 1
    assert counts == {tag: n for tag, n in copies.items() if n}
    library = Tokenizer.from_file(llm.vocabulary(spark, "byte_bpe_50k.json"))
    whole, start = [], 0
    for r in sorted(mixture, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        whole.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    result = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_tokens, r.ids_crc32) for r in result))) == sorted(map(repr, whole))
    ordered = sorted(result, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()


def test_rows_without_files_are_numbered_too(spark, planted):
    rows, _, _ = planted
    docs = common.numbered(spark.createDataFrame(rows, SCHEMA))
    assert docs.select(common.ROW).distinct().count() == len(rows)
    again = docs.select(common.ROW, "tag")
    assert {tuple(r) for r in docs.select(common.ROW, "tag").collect()} == {tuple(r) for r in again.repartition(5).collect()}
