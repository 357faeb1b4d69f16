"""Secrets in texts: rules for known kinds, and a convolutional network over every other candidate."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import with_positions
from casebook.session import written

#: The rules, in the order of their kinds. Fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ASSIGN_LETTERS, ACCESS_LETTERS, HEX_LETTERS = 6, 20, 24
KINDS = ("assign", "access", "hex", "model")

#: A candidate is a run of this many of the characters that keys are made of, not all of them marks.
CANDIDATE_LETTERS = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: Characters before, of and after a candidate that the network sees; a longer one is seen in pieces.
BEFORE, OF, AFTER = 28, 48, 12
WIDTH = BEFORE + OF + AFTER

#: Examples that one group trains on between two means of the groups' networks.
PART_ROWS = 6_000
#: A label weighs as much as this many examples at most, so that one does not drown the other.
BALANCED_ROWS = 3_000
FEW_ROWS = 8
#: The share of calibration findings that a threshold must keep.
LEAST_RECALL = 0.95
#: With fewer calibration findings a shape has the threshold of all shapes, or its own where that is lower.
OWN_FINDINGS = 20
CODES, EMBEDDED, FILTERS, SPAN = 97, 8, 24, 5
EPOCHS, BATCH, STEP = 8, 128, 0.01
#: Newton's steps of the calibration at most, and by how much a threshold lies below its finding's score, which
#: may differ in its last bits when it is computed among others.
NEWTON_STEPS, SLACK = 50, 1e-9


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all findings of the rules, by start and kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LETTERS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LETTERS]
    if any(len(w) >= HEX_LETTERS for w in text.split()):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= HEX_LETTERS]
    return sorted(found)


def candidate_spans(text: str) -> list[tuple[int, int]]:
    if not any(len(w) >= CANDIDATE_LETTERS for w in text.split()):
        return []
    return [(m.start(), m.end()) for m in CANDIDATE.finditer(text) if any(c.isalnum() for c in m[0])]


def window(text: str, start: int, end: int) -> bytes:
    """The candidate and its surrounding as codes: 0 for nothing, 1 to 95 for printable ASCII, 96 for others."""
    parts = (
        text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0"),
        text[start : min(end, start + OF)].ljust(OF, "\0"),
        text[end : end + AFTER].ljust(AFTER, "\0"),
    )
    return bytes(0 if c == "\0" else ord(c) - 31 if " " <= c <= "~" else 96 for c in "".join(parts))


def uncovered(start: int, end: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of a candidate outside these spans that are long enough to be candidates."""
    for first, last in [*sorted(spans), (end, end)]:
        if first - start >= CANDIDATE_LETTERS:
            yield start, first
        start = max(start, last)


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """A candidate, or pieces of OF characters over all of a longer one, each begun in the middle of the one before."""
    if end - start <= OF:
        return [(start, end)]
    return [(s, s + OF) for s in range(start, end - OF, OF // 2)] + [(end - OF, end)]


def shape(candidate: str) -> int:
    """0: digits, 1: hexadecimal, 2: letters of one case and digits, 3: mixed."""
    if candidate.isdigit():
        return 0
    if re.fullmatch(r"[0-9a-fA-F]+", candidate):
        return 1
    return 3 if candidate != candidate.lower() and candidate != candidate.upper() else 2


SHAPES = 4
CANDIDATE_TYPE = pa.list_(
    pa.struct({"start": pa.int64(), "end": pa.int64(), "shape": pa.int32(), "label": pa.int32(), "window": pa.binary()})
)


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every document what the rules find, and all pieces of candidates, labelled by whether a rule covers them.

    What a rule leaves of a candidate is one again, with the label -1: it is judged, but no example.
    """
    for batch in batches:
        rules, candidates = [], []
        for scalar in batch.column(1):
            text = scalar.as_py() or ""
            found = rule_spans(text)
            rules.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            own = []
            for start, end in candidate_spans(text):
                rules_here = [(s, e) for s, _, e in found if s < end and start < e]
                marked = [(start, end, 1 if rules_here else 0)]
                marked += [(a, b, -1) for a, b in uncovered(start, end, rules_here) if rules_here]
                for a, b, label in marked:
                    known = {"start": a, "end": b, "shape": shape(text[a:b]), "label": label}
                    for first, last in pieces(a, b):
                        if label < 1 or any(s < last and first < e for s, e in rules_here):
                            own.append(known | {"window": window(text, first, last)})
            candidates.append(own)
        kind = pa.list_(pa.struct({"start": pa.int64(), "kind": pa.int32(), "end": pa.int64()}))
        yield pa.record_batch(
            [batch.column(0), pa.array(rules, kind), pa.array(candidates, CANDIDATE_TYPE)], names=["doc_id", "rules", "candidates"]
        )


@dataclass
class Network:
    """Characters embedded, convolved, rectified and pooled by their maxima, into one logit."""

    embedding: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: Platt's scaling, and the threshold of every shape of candidates.
    slope: float = 1.0
    shift: float = 0.0
    thresholds: tuple[float, ...] = (2.0,) * SHAPES

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        return Network(
            random.normal(0, 0.3, (CODES, EMBEDDED)), random.normal(0, 0.2, (SPAN * EMBEDDED, FILTERS)),
            np.zeros(FILTERS), random.normal(0, 0.2, FILTERS), np.zeros(1),
        )

    def forward(self, codes: np.ndarray):
        embedded = self.embedding[codes]
        places = codes.shape[1] - SPAN + 1
        spans = np.concatenate([embedded[:, i : i + places] for i in range(SPAN)], axis=2)
        active = np.maximum(spans @ self.filters + self.offsets, 0)
        where = active.argmax(axis=1)
        pooled = np.take_along_axis(active, where[:, None, :], axis=1)[:, 0]
        return spans, where, pooled, pooled @ self.weights + self.bias[0]

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.offsets, self.weights, self.bias]

    def gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        spans, where, pooled, logits = self.forward(codes)
        error = weights * (1 / (1 + np.exp(-logits)) - labels) / len(codes)
        back = error[:, None] * self.weights * (pooled > 0)
        rows = np.arange(len(codes))[:, None]
        taken = spans[rows, where]
        to_filters = np.einsum("nf,nfd->df", back, taken)
        to_spans = back[:, :, None] * self.filters.T
        to_embedding = np.zeros_like(self.embedding)
        for i in range(SPAN):
            letters = codes[rows, where + i]
            np.add.at(to_embedding, letters, to_spans[:, :, i * EMBEDDED : (i + 1) * EMBEDDED])
        return [to_embedding, to_filters, back.sum(axis=0), pooled.T @ error, np.array([error.sum()])]

    def train(
        self, codes: np.ndarray, labels: np.ndarray, weights: tuple[float, float] = (1.0, 1.0),
        epochs: int = EPOCHS, seed: int | tuple[int, int] = 11, moments: Moments | None = None,
    ) -> Moments:
        """Adam over shuffled batches, the labels weighted; goes on from the moments of earlier epochs."""
        moments = moments or Moments.fresh(self)
        by_row = np.where(labels == 1, weights[1], weights[0])
        random = np.random.default_rng(seed)
        for _ in range(epochs):
            order = random.permutation(len(codes))
            for start in range(0, len(codes), BATCH):
                rows = order[start : start + BATCH]
                moments.step += 1
                found = self.gradients(codes[rows], labels[rows], by_row[rows])
                for p, g, m, v in zip(self.parameters(), found, moments.first, moments.second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= STEP * (m / (1 - 0.9**moments.step)) / (np.sqrt(v / (1 - 0.999**moments.step)) + 1e-8)
        return moments

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self.forward(codes[i : i + 512])[3] for i in range(0, len(codes), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return self.scaled(self.logits(codes))

    def scaled(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, shapes: np.ndarray) -> None:
        """Platt's scaling, then for every shape the highest threshold that keeps LEAST_RECALL of its findings."""
        logits = self.logits(codes)
        positive, negative = int(labels.sum()), int(len(labels) - labels.sum())
        self.slope, self.shift = platt(lambda w: platt_sums(logits, labels, w, positive, negative))
        scores = self.scaled(logits)
        found = [scores[(labels == 1) & (shapes == s)] for s in range(SHAPES)]
        kept = [float(np.sort(f)[rank(len(f))]) if len(f) else 2.0 for f in [*found, scores[labels == 1]]]
        self.thresholds = thresholds(kept, [len(f) for f in found])


@dataclass
class Moments:
    """What Adam remembers of the gradients of every parameter, and how many steps it made."""

    first: list[np.ndarray]
    second: list[np.ndarray]
    step: float = 0.0

    @staticmethod
    def fresh(network: Network) -> Moments:
        return Moments(*([np.zeros_like(p) for p in network.parameters()] for _ in range(2)))


def flat(network: Network, moments: Moments) -> np.ndarray:
    """Parameters, moments and steps in a row."""
    return np.concatenate([a.ravel() for a in (*network.parameters(), *moments.first, *moments.second)] + [[moments.step]])


def unflat(values: np.ndarray) -> tuple[Network, Moments]:
    network = Network.fresh()
    moments = Moments.fresh(network)
    at = 0
    for array in (*network.parameters(), *moments.first, *moments.second):
        array[...] = values[at : at + array.size].reshape(array.shape)
        at += array.size
    moments.step = float(values[at])
    return network, moments


def platt_sums(logits: np.ndarray, labels: np.ndarray, w: np.ndarray, positive: int, negative: int) -> np.ndarray:
    """Of a scaling: its loss, the two sums of its gradient, and the three of its second derivatives."""
    # targets short of 0 and 1, as Platt has them
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    z = np.clip(w[0] * logits + w[1], -30, 30)
    p = 1 / (1 + np.exp(-z))
    spread = p * (1 - p) + 1e-9
    rows = [
        np.logaddexp(0, z) - target * z, (target - p) * logits, target - p, spread * logits * logits, spread * logits, spread
    ]
    return np.array([r.sum() for r in rows])


def platt(sums_at: Callable[[np.ndarray], np.ndarray]) -> tuple[float, float]:
    """Slope and shift of Platt's scaling by Newton's steps, halved where the loss would rise."""
    w = np.array([1.0, 0.0])
    now = sums_at(w)
    for _ in range(NEWTON_STEPS):
        step = np.linalg.solve(np.array([[now[3], now[4]], [now[4], now[5]]]) + 1e-6 * np.eye(2), now[1:3])
        while np.abs(step).max() > 1e-6 and not ((after := sums_at(w + step))[0] <= now[0] and w[0] + step[0] > 0):
            step = step / 4
        if np.abs(step).max() <= 1e-6:
            break
        w, before, now = w + step, now, after
        if before[0] - now[0] <= 1e-9 * max(1.0, before[0]):
            break
    return float(w[0]), float(w[1])


def rank(findings: int) -> int:
    """The place, by rising score, of the finding whose score is the highest threshold that keeps LEAST_RECALL of all."""
    return findings - math.ceil(LEAST_RECALL * findings)


def thresholds(kept: list[float], findings: list[int]) -> tuple[float, ...]:
    """Of every shape, from the scores that keep LEAST_RECALL of each shape's findings and, last, of all; above 1 without any."""
    own = [k if n >= OWN_FINDINGS else min(k, kept[-1]) for k, n in zip(kept[:-1], findings, strict=True)]
    return tuple(k - SLACK for k in own)


def codes_of(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), WIDTH).astype(np.int64)


def learner(values: np.ndarray, weights: tuple[float, float], epochs: int, seed: int | tuple[int, int]):
    """Trains a group's examples on from the given network, and returns its values by their places."""

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows["position"]))
        network, moments = unflat(values)
        moments = network.train(
            codes_of(rows["window"].to_pylist()), rows["label"].to_numpy().astype(float), weights, epochs, seed, moments
        )
        after = flat(network, moments)
        return pa.table({"place": np.arange(len(after)), "value": after, "n": np.full(len(after), rows.num_rows)})

    return learn


def trained(examples: DataFrame, sizes: tuple[int, int]) -> Network:
    """A network trained on all examples: after every epoch it is the mean of those trained on from it by groups.

    Groups are made by a hash of the windows, as many as PART_ROWS asks for. Labels of more than BALANCED_ROWS weigh alike.
    """
    parts = max(1, -(-sum(sizes) // PART_ROWS))
    balanced = [min(n, BALANCED_ROWS) for n in sizes]
    weights = tuple(b / n * sum(sizes) / sum(balanced) for b, n in zip(balanced, sizes, strict=True))
    part = F.pmod(F.xxhash64(F.lit("part"), "window"), F.lit(parts)).cast("int").alias("part")
    dealt = examples.select("window", "label", "position", part)
    network = Network.fresh()
    values = flat(network, Moments.fresh(network))
    # one group needs no means
    for epochs, seed in [(EPOCHS, 11)] if parts == 1 else [(1, (11, e)) for e in range(EPOCHS)]:
        learned = dealt.repartition(parts, "part").groupBy("part")
        learned = learned.applyInArrow(learner(values, weights, epochs, seed), "place long, value double, n long")
        means = learned.groupBy("place").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value")).collect()
        values = np.array([r["value"] for r in sorted(means)])
    return unflat(values)[0]


def with_logits(network: Network):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = network.logits(codes_of(batch.column(0).to_pylist()))
            yield pa.record_batch([*batch.columns[1:], pa.array(logits, pa.float64())], names=["label", "shape", "logit"])

    return compute


def sums_of(w: np.ndarray, positive: int, negative: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = platt_sums(batch.column(1).to_numpy(), batch.column(0).to_numpy(), w, positive, negative)
            yield pa.record_batch([pa.array([s]) for s in sums], names=SUMS)

    return compute


SUMS = [f"s{i}" for i in range(6)]


def calibrated(network: Network, examples: DataFrame) -> Network:
    """The network with Platt's scaling and thresholds, both from all examples."""
    judged = examples.select("window", "label", "shape").mapInArrow(with_logits(network), "label int, shape int, logit double")
    judged = written(judged, "logits")
    counted = {(r["label"], r["shape"]): r["n"] for r in judged.groupBy("label", "shape").agg(F.count("*").alias("n")).collect()}
    positive, negative = (sum(n for (label, _), n in counted.items() if label == k) for k in (1, 0))

    def sums_at(w: np.ndarray) -> np.ndarray:
        parts = judged.select("label", "logit").mapInArrow(sums_of(w, positive, negative), ", ".join(f"{s} double" for s in SUMS))
        return np.array(parts.agg(*[F.sum(s) for s in SUMS]).first(), float)

    network.slope, network.shift = platt(sums_at)
    # the scaling rises, so the finding of a rank is that of its logit; by shape, then of all
    findings = [counted.get((1, s), 0) for s in range(SHAPES)]
    positives = judged.filter("label = 1")
    first = np.cumsum([0, *findings])
    kept = [2.0] * (SHAPES + 1)
    by_shape = {int(first[s]) + rank(n): s for s, n in enumerate(findings) if n}
    for order, wanted in ((["shape", "logit"], by_shape), (["logit"], {rank(positive): SHAPES})):
        placed = with_positions(positives.select("shape", "logit"), order, "findings")
        for r in placed.filter(F.col("position").isin(list(wanted))).collect():
            kept[wanted[r["position"]]] = float(network.scaled(np.array([r["logit"]]))[0])
    network.thresholds = thresholds(kept, findings)
    return network


def fit(found: DataFrame) -> Network:
    """A network trained and calibrated on all candidates: those that rules found, and all others.

    Repeated windows count once. By label and hash, every fourth calibrates and the rest trains. Where one
    label has fewer than FEW_ROWS, all train and all calibrate. Without candidates of both labels nothing can
    be learned, and the network finds nothing.
    """
    candidates = found.select(F.explode("candidates").alias("c")).select("c.window", "c.label", "c.shape").filter("label >= 0")
    distinct = written(candidates.distinct().withColumn("hash", F.xxhash64("window")), "candidates-once")
    placed = with_positions(distinct, ["label", "hash", "window", "shape"], "examples")
    examples = placed.withColumn("calibrates", F.col("position") % 4 == 3)
    sizes = {(r["calibrates"], r["label"]): r["n"] for r in examples.groupBy("calibrates", "label").agg(F.count("*").alias("n")).collect()}
    train, calibrate = (tuple(sizes.get((kind, label), 0) for label in (0, 1)) for kind in (False, True))
    both = tuple(t + c for t, c in zip(train, calibrate, strict=True))
    if not all(both):
        return Network.fresh()
    if min(both) < FEW_ROWS:
        return calibrated(trained(examples, both), examples)
    return calibrated(trained(examples.filter("not calibrates"), train), examples.filter("calibrates"))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def reporter(network: Network):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = np.array(network.thresholds)
        for batch in batches:
            rules, candidates = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            asked = [(i, c) for i, own in enumerate(candidates) for c in own or [] if c["label"] < 1]
            added: list[set[tuple[int, int, int]]] = [set() for _ in rules]
            if asked:
                scores = network.probabilities(codes_of([c["window"] for _, c in asked]))
                for (i, c), score in zip(asked, scores, strict=True):
                    if score >= limits[c["shape"]]:
                        added[i].add((c["start"], 3, c["end"]))
            base = [[(r["start"], r["kind"], r["end"]) for r in own or []] for own in rules]
            counts = [[sum(kind == k for _, kind, _ in own) for own in base] for k in range(3)]
            yield pa.record_batch(
                [
                    batch.column(0), *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([hashlib.sha256(joined(own).encode()).hexdigest() for own in base]),
                    pa.array([joined(sorted([*own, *more])) for own, more in zip(base, added, strict=True)]),
                    pa.array([len(more) for more in added], pa.int64()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"],
            )

    return report


def find_secrets(docs: DataFrame) -> DataFrame:
    """All secrets in every whole text: what the rules find, and the candidates the network takes for one.

    One pass over the texts finds both the rules' spans and all candidates with their surroundings; the
    candidates inside the rules' findings are the labelled examples; the network learns from all of them
    and of the others, in groups whose networks are averaged after every epoch, with a
    calibrated threshold for every shape of candidates that keeps LEAST_RECALL of these; a shape with
    few of them has the threshold of all shapes. It then
    judges every other candidate, a long one by the best of its pieces, and what the rules leave of those
    they cover in part. Nothing is shuffled but distinct candidates.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_model, one row for each row of
    ``docs``. Spans are kind:start:end in code points, by start and then kind. Null texts count as
    empty and have none; repeated rows and null ids are rows like others; an empty table gives no
    rows. Further columns are not read.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_type}, rules array<struct<start:long,kind:int,end:long>>, "
        "candidates array<struct<start:long,end:long,shape:int,label:int,window:binary>>"
    )
    found = written(docs.select("doc_id", "text").mapInArrow(find, schema), "candidates")
    schema = f"doc_id {doc_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long"
    return found.mapInArrow(reporter(fit(found)), schema)
