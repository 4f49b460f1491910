"""Toxicity by weak supervision.

Voters are lexicon entries and patterns. Entries are whole words and word beginnings that occur in
toxic training documents far more often than chance (likelihood ratio; at least GROUPS of those
documents must not be copies of one another, by their smallest shingle hash); no word is given
beforehand. Patterns are on the number and density of entries that fire. A generative model takes
the true label of a document as hidden; the given label is one more voter, of a fixed accuracy (HIT,
MISS), that anchors it. Expectation maximisation estimates in every round how often each voter
fires on either label (its accuracy), and from what the hidden label leaves unexplained which
voters fire together; these share their weight. As dependences of more than two voters stay, all
votes together move the log odds by BELIEF at most. A linear classifier is fitted to the posterior
labels and scores all texts.

Labels come from training rows only. Counts of words by label run over all training rows; the
voter matrix and the classifier are fitted on at most SAMPLE training rows and as many different
rows of votes (smallest hashes first), equal rows by their number. Ids and labels are broadcast,
packed where there are at most PACKED of them, so that no text is shuffled; beyond that the texts
of labelled rows are shuffled once. Every document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from pagewright.llm.common import cut, drop_cut
from pagewright.llm.shingles import mix, shingle_set

SAMPLE, LEXICON, SURE, GROUPS = 30_000, 600, 25.0, 5
PACKED = 20_000_000
THRESHOLD = 0.3
STEMS = (4, 5, 6)
#: How often the given label says 1 where the hidden one is 1, and where it is 0; most log odds of all votes.
HIT, MISS, BELIEF = 0.98, 0.002, 3.0
#: A longer word is known by its hash.
LONG = 24
_LETTERS = re.compile(r"[^\W\d_]+")


def entries(text: str | None) -> set[str]:
    """Distinct words and word beginnings ("stem-") of a text, lowered."""
    found = set(_LETTERS.findall((text or "").lower()))
    out = {known_as(w) for w in found}
    for n in STEMS:
        out.update(w[:n] + "-" for w in found if len(w) > n)
    return out


def known_as(word: str) -> str:
    return word if len(word) <= LONG else "#" + xxh3_128_hexdigest(word.encode("utf-8", "surrogatepass"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[int]] = {}

    def table():
        cols = list(zip(*held.values(), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(list(held)), *[pa.array(c, pa.int64()) for c in cols]], names=["entry", "clean", "toxic", "groups"])

    for batch in batches:
        for t, y in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            text = t.as_py()
            bit = 0
            if y and len(found := shingle_set(text)):
                bit = 1 << int(mix(found[:1])[0] % 63)
            for x in entries(text):
                h = held.setdefault(x, [0, 0, 0])
                h[y] += 1
                h[2] |= bit
        if len(held) > 300_000:
            yield table()
            held = {}
    if held:
        yield table()


def likelihood_ratio(a, b, n1, n0):
    """Columns: how surely an entry in a of n1 toxic and b of n0 clean documents is more toxic than chance."""
    def part(k, n, p):
        p = F.greatest(F.lit(1e-12), F.least(p, F.lit(1 - 1e-12)))
        return k * F.log(p) + (n - k) * F.log(1 - p)

    whole = (a + b) / F.lit(float(n1 + n0))
    own = part(a, float(n1), a / F.lit(float(n1))) + part(b, float(n0), b / F.lit(float(n0)))
    same = part(a, float(n1), whole) + part(b, float(n0), whole)
    return F.when(a / F.lit(float(n1)) > 5 * b / F.lit(float(n0)), 2 * (own - same)).otherwise(0.0)


def count_entries(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """entry, b and a (clean and toxic documents that hold it) and groups, over all of docs that rows labels."""
    schema = "entry string, clean long, toxic long, groups long"
    if rows.count() > PACKED:
        found = docs.join(rows, "doc_id").select("text", "toxic").mapInArrow(_count, schema)
    else:
        t = rows.toArrow()
        ids, toxic = t.column("doc_id").to_numpy(), t.column("toxic").to_numpy().astype(np.int8)
        order = np.argsort(ids, kind="stable")
        known = docs.sparkSession.sparkContext.broadcast((ids[order], toxic[order]))

        def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, toxic = known.value
            for batch in batches:
                i = batch.column("doc_id").to_numpy()
                k = np.minimum(np.searchsorted(ids, i), len(ids) - 1)
                hit = ids[k] == i
                yield pa.RecordBatch.from_arrays([batch.column("text").filter(pa.array(hit)), pa.array(toxic[k[hit]])], names=["text", "toxic"])

        found = docs.filter("doc_id is not null").mapInArrow(lambda batches: _count(labelled(batches)), schema)
    return found.groupBy("entry").agg(F.sum("clean").alias("b"), F.sum("toxic").alias("a"), F.bit_or("groups").alias("groups"))


def lexicon(docs: DataFrame, rows: DataFrame) -> list[str]:
    """The up to LEXICON surest entries that no surer one covers; counts cover all training rows."""
    n = {r["toxic"]: r["n"] for r in docs.select("doc_id").join(rows, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    counts = count_entries(docs, rows)
    sure = counts.filter(F.bit_count("groups") >= GROUPS).withColumn("lr", likelihood_ratio(F.col("a"), F.col("b"), n1, n0)).filter(F.col("lr") >= SURE)
    top = sure.orderBy(F.desc("lr"), "entry").limit((len(STEMS) + 1) * LEXICON).select("entry").collect()
    return compact([r[0] for r in top])[:LEXICON]


def compact(found: list[str]) -> list[str]:
    """Entries in order, without those that an earlier beginning covers."""
    out, stems = [], set()
    for x in found:
        s = x.rstrip("-")
        # a word of n letters is covered by beginnings of fewer, a beginning by shorter ones
        if not any(len(s) > n and s[:n] in stems for n in STEMS):
            out.append(x)
            if x != s:
                stems.add(s)
    return out


def votes(text: str | None, place: dict[str, int]) -> np.ndarray:
    """One vote per lexicon entry, then the pattern voters: any hit, two, four or more, dense hits."""
    found = _LETTERS.findall((text or "").lower())
    out = np.zeros(len(place) + 4, np.float32)
    hits = 0
    for w in set(found):
        here = False
        for x in (known_as(w), *(w[:n] + "-" for n in STEMS if len(w) > n)):
            k = place.get(x)
            if k is not None:
                out[k] = 1
                here = True
        hits += here
    out[-4:] = hits >= 1, hits >= 2, hits >= 4, hits >= 1 and hits >= len(found) / 100
    return out


def label_model(v: np.ndarray, y: np.ndarray, count: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Posterior of label 1 for every row of votes v with given label y, which stands for `count` documents."""
    total = count.sum()
    told = math.log(prior / (1 - prior)) + np.where(y == 1, math.log(HIT / MISS), math.log((1 - HIT) / (1 - MISS)))
    post = 1 / (1 + np.exp(-told))
    weight = np.ones(v.shape[1])
    for _ in range(rounds):
        on, off = post * count, (1 - post) * count
        p1 = (on @ v + 0.5) / (on.sum() + 1)
        p0 = (off @ v + 0.5) / (off.sum() + 1)
        # what the hidden label leaves unexplained: voters that fire together share their weight
        rest = v - np.outer(post, p1) - np.outer(1 - post, p0)
        scale = np.sqrt((count @ rest**2) / total) + 1e-9
        corr = np.abs((rest * count[:, None] / scale).T @ (rest / scale) / total)
        np.fill_diagonal(corr, 1)
        corr[corr < 0.2] = 0
        weight = 0.5 * weight + 0.5 / np.maximum(1, corr.sum(axis=1))
        odds = (v * weight) @ (np.log(p1) - np.log(p0)) + ((1 - v) * weight) @ (np.log1p(-np.minimum(p1, 0.999)) - np.log1p(-np.minimum(p0, 0.999)))
        new = 1 / (1 + np.exp(-(told + np.clip(odds, -BELIEF, BELIEF))))
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-4:
            break
    return post


def linear(v: np.ndarray, post: np.ndarray, count: np.ndarray, steps: int = 30, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels by Newton steps; the intercept is not penalised."""
    x = np.concatenate([v, np.ones((len(v), 1), v.dtype)], axis=1).astype(np.float64)
    ridge = np.full(x.shape[1], penalty * count.sum())
    ridge[-1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (count * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (count * (p - post)) + ridge * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, int], np.ndarray, float]:
    """Lexicon and linear classifier, from the labelled rows whose crc32(doc_id) mod 4 is not 2."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = cut(rows, "toxicity-labels")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = {x: k for k, x in enumerate(lexicon(docs, rows))}
    chosen = cut(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "toxicity-sample")
    train = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    width = len(place) + 4

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [np.packbits(votes(t.as_py(), place) > 0).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(bits, pa.binary())], names=["toxic", "votes"])

    rows_of = train.mapInArrow(cast, "toxic int, votes binary").groupBy("toxic", "votes").agg(F.count("*").alias("n"))
    seen = rows_of.orderBy(F.xxhash64("votes", "toxic"), "votes", "toxic").limit(SAMPLE).collect()
    drop_cut(rows, chosen)
    if not seen or not place:
        return place, np.zeros(width), -3.0
    v = np.stack([np.unpackbits(np.frombuffer(bytes(r["votes"]), np.uint8), count=width) for r in seen]).astype(np.float32)
    y, count = np.array([r["toxic"] for r in seen]), np.array([r["n"] for r in seen], np.float64)
    w, b = linear(v, label_model(v, y, count, (y @ count + 1) / (count.sum() + 2)), count)
    return place, w, b


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs.

    A null text scores as an empty one, with the score of a document without any hit. A null doc_id
    is held_out null. Repeated rows are scored alike; labels that contradict count as toxic; labels
    other than 0 and 1 don't count. Without any usable label all score alike, as clean. An empty
    table gives an empty result; further columns are ignored.
    """
    place, w, b = fit(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.array([votes(t.as_py(), place) @ w + b for t in batch.column("text")], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score reaches the threshold; all columns stay.

    Null and empty texts score as texts without any hit and stay; rows with a null doc_id and rows that
    repeat are judged by their texts like all others. An empty table gives an empty result.
    """
    place, w, b = fit(docs, labels)
    names = docs.columns
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.array([votes(t.as_py(), place) @ w + b for t in batch.column("text")], np.float64)
            yield batch.filter(pa.array(1 / (1 + np.exp(-z)) < threshold))

    return docs.mapInArrow(keep, schema).select(names)
