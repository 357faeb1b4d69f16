"""Toxicity of whole texts: Levenshtein automata over a learned lexicon, and scores of the context."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import ROW, crc32_of, give_back, numbered, without_rows
from casebook.session import written

#: Labelled rows the model is fitted on at most: the bounded sample. Two thirds teach the lexicon, the
#: rest the weights. All documents are scored.
SAMPLE_ROWS = 12_000
#: Terms of the lexicon at most, and spellings that are weighed for it at most.
TERMS = 2_000
CANDIDATES = 50_000
#: A term is in this many toxic documents of the sample at least, and this many times likelier there.
SUPPORT = 4
LIFT = 6.0
#: Letters of stems, which count when more letters follow, and of the shortest term with a tolerated edit.
STEM_LETTERS = range(4, 10)
EDITED_LETTERS = 5
#: What an edit takes from the log-odds of a term: one that is barely in the lexicon has no misspellings.
EDIT_PENALTY = math.log(LIFT)
#: A spelling with an edit that this many clean documents of the sample hold may be a word of its own.
COMMON = 2
#: Words on both sides that make up the context of a finding.
CONTEXT_WORDS = 12
THRESHOLD = 0.3
#: Words and states a task remembers.
KEPT = 500_000

WORD = re.compile(r"[^\W_]+")
#: Quotation marks that open, those that each mark may close, and what stands after a closing one.
OPENING = "\"“„«»‘‚‹›"
CLOSED_BY = {'"': '"', "”": "“„", "“": "„", "»": "«", "«": "»", "’": "‘‚", "‘": "‚", "›": "‹", "‹": "›"}
MARK = re.compile("[\"“”„«»‘’‚‹›]")
ENDS = ".,;:!?)]}…"
N_FEATURES = 9


@dataclass
class Lexicon:
    """A trie of terms whose Levenshtein automata are run as one automaton, made as words need it.

    A state is the set of places (node of the trie, edits used) that a word's letters so far may
    lead to, with one edit at most. Most words leave the automaton after two or three letters.
    """

    terms: dict[str, float]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, tuple[str, bool]] = field(default_factory=dict)
    #: Words that are no misspellings though they are one edit away from a term.
    common: frozenset[str] = frozenset()

    def __post_init__(self):
        for term in self.terms:
            node = 0
            for letter in term[1:]:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                node = self.children[node][letter]
            # a node may end a whole word and a stem
            whole, stem = self.ends.get(node, (None, None))
            self.ends[node] = (term, stem) if term[0] == "=" else (whole, term)
        self.restart()

    def restart(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.root = self.state(self.closed({(0, 0)}))
        self.known: dict[str, tuple[str, int] | None] = {}

    def closed(self, places: set[tuple[int, int]]) -> frozenset:
        """With the places reached by leaving out one letter of a term."""
        skipped = {(child, 1) for node, edits in places if edits == 0 for child in self.children[node].values()}
        best: dict[int, int] = {}
        for node, edits in places | skipped:
            best[node] = min(edits, best.get(node, 1))
        return frozenset(best.items())

    def state(self, places: frozenset) -> int:
        if places not in self.states:
            self.states[places] = len(self.sets)
            self.sets.append(places)
            self.moves.append({})
        return self.states[places]

    def move(self, state: int, letter: str) -> int:
        after: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            down = self.children[node]
            if letter in down:
                after.add((down[letter], edits))
            if edits == 0:
                after.add((node, 1))
                after.update((child, 1) for child in down.values())
        self.moves[state][letter] = found = self.state(self.closed(after))
        return found

    def look_up(self, word: str) -> tuple[str, int] | None:
        """The term a word spells and the edits in it (0 or 1), or None."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > KEPT or len(self.sets) > KEPT:
            self.restart()
        state, stem = self.root, None
        for at, letter in enumerate(word):
            state = self.moves[state].get(letter) or self.move(state, letter)
            places = self.sets[state]
            if not places:
                break
            if at + 1 < len(word):
                for node, edits in places:
                    if edits == 0 and node in self.ends and self.ends[node][1]:
                        stem = self.ends[node][1]
        found = (stem, 0) if stem else None
        reached = [
            (edits, -self.terms[term], term) for node, edits in self.sets[state]
            if node in self.ends and (term := self.ends[node][0])
            and (edits == 0 or found is None and len(term) - 1 >= EDITED_LETTERS and word not in self.common)
        ]
        # the word itself before its misspellings, of these the strongest
        for edits, _, term in sorted(reached)[:1]:
            found = (term, edits)
        self.known[word] = found
        return found


def quotations(text: str) -> tuple[list[int], list[int]]:
    """Where quotations begin, in order, and the furthest end of those up to each: pairs of marks, in one scan.

    A closing mark belongs to the last open one of its kind, and ends what was opened in between. Marks
    that stay unpaired open nothing; ’ and ‘ inside or before the rest of a word are apostrophes.
    """
    opened: dict[str, list[int]] = {kind: [] for kind in OPENING}
    pairs = []
    for match in MARK.finditer(text):
        mark, at = match[0], match.start()
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        opens = (not before or before.isspace() or before in "([{") and bool(after) and not after.isspace() and after not in ENDS
        closes = bool(before) and not before.isspace() and before not in "([{" and (not after or after.isspace() or after in ENDS)
        kinds = [kind for kind in CLOSED_BY.get(mark, "") if opened[kind]]
        if mark == "’" and after.isalnum() or mark in "«‹" and not closes or mark in "\"“‘" and opens:
            kinds = []
        if kinds:
            start = max(opened[kind][-1] for kind in kinds)
            pairs.append((start, at))
            for places in opened.values():
                while places and places[-1] >= start:
                    places.pop()
        elif mark in OPENING and not closes and not before.isalnum() and (opens or mark not in "»›"):
            if mark == '"':
                opened[mark].clear()
            opened[mark].append(at)
    pairs.sort()
    return [start for start, _ in pairs], list(accumulate((end for _, end in pairs), max))


def quoted(quotes: tuple[list[int], list[int]], start: int, end: int) -> bool:
    """Whether a pair of marks is around a place."""
    number = bisect_left(quotes[0], start)
    return number > 0 and quotes[1][number - 1] >= end


def features(text: str, lexicon: Lexicon) -> np.ndarray:
    """What the findings of a text say: how many, how strong, how dense, how near, whether quoted.

    A misspelled term is a finding like the term, less its EDIT_PENALTY: no weight hangs on misspellings
    alone, of which a sample may hold none.
    """
    values = np.zeros(N_FEATURES)
    lowered = text.lower()
    words = WORD.findall(lowered)
    values[0] = math.log1p(len(words))
    hits = {w: found for w in set(words) if (found := lexicon.look_up(w))}
    if not hits:
        return values
    at, weight, spelled, stems, cited, strength, best = [], 0.0, 0.0, 0, 0, 0.0, 0.0
    quotes = quotations(lowered)
    for number, match in enumerate(WORD.finditer(lowered)):
        found = hits.get(match[0])
        if not found:
            continue
        term, edits = found
        if quoted(quotes, match.start(), match.end()):
            cited += 1
            continue
        odds = lexicon.terms[term]
        left = max(0.0, odds - EDIT_PENALTY * edits)
        if not left:
            continue
        spelled += (term[0] == "=") * left / odds
        stems += term[0] == "^"
        at.append(number)
        weight += left / odds
        strength += left
        best = max(best, left)
    # the most findings within a context window
    near = max((int(np.searchsorted(at, a + 2 * CONTEXT_WORDS, "right")) - i for i, a in enumerate(at)), default=0)
    values[1:] = [
        math.log1p(spelled), math.log1p(stems), float(spelled > 0), math.log1p(cited),
        best, math.log1p(strength), min(5.0, 100 * weight / len(words)), math.log1p(near),
    ]
    return values


@dataclass
class Model:
    lexicon: dict[str, float]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    common: frozenset[str] = frozenset()

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def spellings(text: str) -> set[str]:
    """Whole words, marked =, and beginnings of longer words, marked ^."""
    found = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) > 2:
            found.add("=" + word)
        found.update("^" + word[:n] for n in STEM_LETTERS if n < len(word))
    return found


def count_spellings(wanted: frozenset | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                found = spellings(text or "")
                held.update(found if wanted is None else found & wanted)
            yield pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["spelling", "n"])

    return count


def remainder(column: str = "doc_id") -> Column:
    """The fold of a row: crc32 of its id as text, mod 4; a null id is the empty text."""
    return crc32_of(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, part: labelled documents outside the held-out fold, the first SAMPLE_ROWS by a hash."""
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(remainder() != 2)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(SAMPLE_ROWS)
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3))
    chosen = written(chosen.select(F.col("doc_id").alias("_id"), "toxic", part.alias("part")), "chosen")
    # SAMPLE_ROWS rows at most
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return written(joined.select("text", F.col("toxic").cast("int").alias("toxic"), "part"), "labelled")


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms with their log-odds of toxic documents, from the first two parts of the sample."""
    sizes = {r["toxic"]: r["n"] for r in sample.filter("part < 2").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {}
    schema = "spelling string, n long"

    def counted(toxic: int, wanted: frozenset | None) -> DataFrame:
        rows = sample.filter((F.col("part") < 2) & (F.col("toxic") == toxic)).select("text")
        return rows.mapInArrow(count_spellings(wanted), schema).groupBy("spelling").agg(F.sum("n").alias("n"))

    support = counted(1, None).filter(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "spelling").limit(CANDIDATES)
    toxic = {r["spelling"]: r["n"] for r in support.collect()}
    clean = {r["spelling"]: r["n"] for r in counted(0, frozenset(toxic)).collect()}
    odds = {}
    for spelling, n in toxic.items():
        lift = ((n + 0.5) / (sizes[1] + 1)) / ((clean.get(spelling, 0) + 0.5) / (sizes[0] + 1))
        if lift >= LIFT:
            odds[spelling] = math.log(lift)
    # a stem adds nothing when one word makes up most of it; the word also has its misspellings found
    most: dict[str, int] = {}
    for spelling in odds:
        if spelling[0] == "=":
            for n in STEM_LETTERS:
                stem = "^" + spelling[1 : n + 1]
                most[stem] = max(most.get(stem, 0), toxic[spelling])
    odds = {s: o for s, o in odds.items() if s[0] == "=" or most.get(s, 0) < 0.8 * toxic[s]}
    kept: dict[str, float] = {}
    # nor does a spelling when a stem of it is as good a sign
    for spelling in sorted(odds, key=lambda s: (len(s), s)):
        stem_odds = [kept.get("^" + spelling[1:n]) for n in range(STEM_LETTERS.start + 1, len(spelling))]
        if all(s is None or odds[spelling] > s + 0.5 for s in stem_odds):
            kept[spelling] = odds[spelling]
    strongest = sorted(kept, key=lambda s: (-kept[s] * math.log1p(toxic[s]), s))[:TERMS]
    return {s: kept[s] for s in strongest}


def count_misspellings(lexicon: dict[str, float]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(lexicon)
        for batch in batches:
            held: Counter[tuple[str, int]] = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower()))
                held.update((w, toxic) for w in words if (found := automaton.look_up(w)) and found[1])
            columns = [[w for w, _ in held], [t for _, t in held], list(held.values())]
            kinds = [pa.string(), pa.int32(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "toxic", "n"])

    return count


def common_words(sample: DataFrame, lexicon: dict[str, float]) -> frozenset[str]:
    """Words one edit away from a term that clean documents of the first two parts hold as well."""
    rows = sample.filter("part < 2")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not lexicon or len(sizes) < 2:
        return frozenset()
    counted = rows.select("text", "toxic").mapInArrow(count_misspellings(lexicon), "word string, toxic int, n long")
    toxic, clean = (F.coalesce(F.sum(F.when(F.col("toxic") == kind, F.col("n"))), F.lit(0)) for kind in (1, 0))
    forms = counted.groupBy("word").agg(toxic.alias("t"), clean.alias("c")).filter(F.col("c") >= COMMON)
    lift = ((F.col("t") + 0.5) / (sizes[1] + 1)) / ((F.col("c") + 0.5) / (sizes[0] + 1))
    return frozenset(r["word"] for r in forms.filter(lift < LIFT).select("word").collect())


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights of a logistic regression by Newton's steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    scale[scale < 1e-6] = 1.0
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def feature_batches(lexicon: dict[str, float], common: frozenset[str]):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(lexicon, common=common)
        for batch in batches:
            rows = [features(t or "", automaton) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([r.tolist() for r in rows], pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    return compute


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from at most SAMPLE_ROWS labelled rows outside the held-out fold.

    Without labels of both kinds, or words that tell them apart, nothing is learned and all scores are 0.
    """
    sample = labelled_sample(docs, labels)
    lexicon = learn_lexicon(sample)
    common = common_words(sample, lexicon)
    rows = sample.filter("part = 2").select("text", "toxic")
    rows = rows.mapInArrow(feature_batches(lexicon, common), "x array<double>, toxic int")
    found = rows.toArrow()
    y = found.column("toxic").to_numpy().astype(float)
    if not lexicon or len(set(y)) < 2:
        return Model({}, np.zeros(N_FEATURES), np.ones(N_FEATURES), np.array([-30.0] + [0.0] * N_FEATURES))
    x = np.array(found.column("x").to_pylist())
    return Model(lexicon, *logistic(x, y), common)


def scorer(model: Model, text_at: int, name: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(model.lexicon, common=model.common)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([features(t.as_py() or "", automaton) for t in batch.column(text_at)])
            yield pa.record_batch([*batch.columns, pa.array(model.scores(x))], names=[*batch.schema.names, name])
        give_back()

    return score


def with_scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs``, and the score under ``name``; a column of that name in the input is replaced."""
    docs = docs.drop(name)
    schema = ", ".join(f"`{column}` {kind}" for column, kind in docs.dtypes) + f", {name} double"
    return docs.mapInArrow(scorer(model, docs.columns.index("text"), name), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The toxicity of every whole text, learned from ``labels.toxic``.

    Words and stems that mark toxic documents are learned from the sample into a lexicon. All words
    of all documents run through the automaton of its spellings with one edit; a misspelled term counts
    as the term less a penalty, unless clean documents of the sample hold that spelling. Findings in
    pairs of quotation marks, however long, are counted apart, and number, strength, density and nearness of the others make the
    score by logistic regression. Only the text is an input of the score. Scoring is one pass
    without a shuffle.

    Returns doc_id, held_out (the fold that nothing is learned from), score (0 to 1) and predicted
    (1 from 0.3), one row for each row of ``docs``; null and empty texts have the score of a text
    without words; null ids are held out or not by the crc32 of the empty text; labels that are
    null or of no document are not used, repeated ones count as their maximum. An empty table
    gives no rows. Further columns are not read.
    """
    scored = with_scores(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", (remainder() == 2).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows not predicted toxic, with all their columns.

    Only texts and row numbers go to the model, and only the numbers of toxic rows come back.
    """
    rows = numbered(docs)
    scored = with_scores(rows.select(ROW, "text"), fit(docs, labels))
    return without_rows(rows, scored.filter(F.col("score") >= THRESHOLD).select(F.col(ROW).alias("_found")))
