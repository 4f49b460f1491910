"""Language-model scores by a subword lattice.

The model is a unigram model over the pieces of an existing vocabulary. Its weights start from the
vocabulary's own scores and are fitted to the word counts of all training documents (expectation
maximisation over the lattice). A word's probability is the sum over all ways to write it in
pieces, by the forward recursion in log space; a text's is the product over its words and its end:
this marginal is `score`. The lattice runs once for every distinct word of the corpus, not for
every token.

`mixed_score`, a further column, is that of a model in which a word that training documents have c
times also has an edge of its own, of probability (c - DISCOUNT) / N, and the piece paths share the
mass taken off.

The vocabulary at hand is a BPE model: its scores are the ranks of its merges, not log
probabilities. Rank r is taken as the weight 1 / (r + 100), after Zipf; a file whose scores are log
probabilities (a unigram model) keeps them. Texts have A-Z lowered, so pieces are lowered alike and
those that become equal add their weights.

The HEAD most frequent words are looked up where the text is read (a table of bounded size); all
others are counted by document, sent to the word's own partition and joined there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import LOWER, UPPER, cut, drop_cut

HEAD, ROUNDS, PRIOR, DISCOUNT = 20_000, 2, 1000.0, 0.75
SPACE = 0x2581
_P = np.uint64(0x9E3779B97F4A7C15)
_LOW = str.maketrans(UPPER, LOWER)


def load_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces of a vocabulary file, A-Z lowered, and the log probabilities its scores stand for.

    Bytes, control and unknown pieces stand for no text of their own; all others count.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    ranks = all(sp.get_score(i) == round(sp.get_score(i)) for i in plain)
    found: dict[str, float] = {}
    for i in plain:
        piece = sp.id_to_piece(i).translate(_LOW)
        found[piece] = found.get(piece, 0.0) + (1 / (100 - sp.get_score(i)) if ranks else math.exp(sp.get_score(i)))
    pieces = sorted(found)
    w = np.array([found[p] for p in pieces])
    return pieces, np.log(w / w.sum())


class Lattice:
    """Segmentations of words (lowered, with the space mark in front) into pieces, a batch of equal length at a time."""

    #: Log probability of a character outside the vocabulary: a rare event, then one of the code points.
    UNKNOWN = math.log(1e-4) - math.log(0x110000)

    def __init__(self, pieces: list[str], logp: np.ndarray):
        keys = np.array([self._key(p) for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.keys >> np.uint64(42)] = True
        self.longest = max(map(len, pieces))
        self.logp = logp

    @staticmethod
    def _key(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = (h + np.uint64(ord(c))) * _P
        return h[0]

    def _edges(self, codes: np.ndarray):
        """For every length: piece numbers (-1: none) of the substrings that begin at each place."""
        n, length = codes.shape
        h = np.zeros((n, length), np.uint64)
        for size in range(1, min(self.longest, length) + 1):
            h = (h[:, : length - size + 1] + codes[:, size - 1 :]) * _P
            ids = np.full(h.shape, -1, np.int32)
            at = np.nonzero(self.maybe[h >> np.uint64(42)])
            if len(at[0]):
                k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
                hit = self.keys[k] == h[at]
                ids[at[0][hit], at[1][hit]] = self.order[k[hit]]
            yield size, ids

    def run(self, words: list[str], counts: np.ndarray | None = None, sums: np.ndarray | None = None) -> np.ndarray:
        """Natural log of every word's probability; adds expected piece counts to sums if counts are given."""
        out = np.empty(len(words))
        lens = np.array([len(w) for w in words])
        for length in np.unique(lens):
            rows = np.flatnonzero(lens == length)
            step = max(1, 200_000 // (int(length) + 1))
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                text = "".join(words[i] for i in part)
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), -1).astype(np.uint64)
                codes = np.concatenate([np.full((len(part), 1), SPACE, np.uint64), codes], axis=1)
                out[part] = self._batch(codes, None if counts is None else counts[part], sums)
        return out

    def _batch(self, codes: np.ndarray, counts, sums) -> np.ndarray:
        n, length = codes.shape
        edges, logs = [], []
        for size, ids in self._edges(codes):
            lp = np.where(ids >= 0, self.logp[ids], -np.inf)
            if size == 1:
                lp = np.where(ids >= 0, lp, self.UNKNOWN)
            edges.append(ids)
            logs.append(lp)
        ahead = np.full((length + 1, n), -np.inf)
        ahead[0] = 0
        for end in range(1, length + 1):
            ahead[end] = self._sum([ahead[end - s] + logs[s - 1][:, end - s] for s in range(1, min(len(logs), end) + 1)])
        if sums is not None:
            back = np.full((length + 1, n), -np.inf)
            back[length] = 0
            for at in range(length - 1, -1, -1):
                back[at] = self._sum([back[at + s] + logs[s - 1][:, at] for s in range(1, min(len(logs), length - at) + 1)])
            for s, (ids, lp) in enumerate(zip(edges, logs, strict=True), 1):
                r, c = np.nonzero(ids >= 0)
                if len(r):
                    w = counts[r] * np.exp(ahead[c, r] + lp[r, c] + back[c + s, r] - ahead[length, r])
                    sums += np.bincount(ids[r, c], w, len(sums))
        return ahead[length]

    @staticmethod
    def _sum(parts: list[np.ndarray]) -> np.ndarray:
        x = np.stack(parts)
        top = x.max(axis=0)
        return top + np.log(np.exp(x - top).sum(axis=0))


def split(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _strings(found: list[bytes]) -> pa.Array:
    return pa.array(found, pa.binary()).cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[bytes, int] = {}
    learnt: dict[bytes, int] = {}

    def table():
        return pa.RecordBatch.from_arrays([_strings(list(seen)), pa.array([learnt.get(w, 0) for w in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["word", "c", "n"])

    for b in batches:
        for t, train in zip(b.column("text"), b.column("train").to_pylist(), strict=True):
            found = split(t.as_py())
            for w in found:
                seen[w] = seen.get(w, 0) + 1
            if train:
                for w in found:
                    learnt[w] = learnt.get(w, 0) + 1
        if len(seen) > 200_000:
            yield table()
            seen, learnt = {}, {}
    if seen:
        yield table()


def score_documents(docs: DataFrame, vocabulary: str, fold: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and mixed_score of every row of docs.

    held_out: crc32(doc_id as text) mod `fold` is `held`; the rest is learnt from. A null or empty text
    is its end token alone. A null doc_id is held_out null, not learnt from, and scored. Repeated rows
    count each. Words of any length run through the lattice whole. Without training rows base counts
    are 0 and the vocabulary's own scores hold. An empty table gives an empty result; further columns
    are ignored.
    """
    spark = docs.sparkSession
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(fold)) == held
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    train = F.coalesce(~F.col("held_out"), F.lit(False))
    types = rows.select("text", train.alias("train")).mapInArrow(_count, "word string, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    types = cut(types, "lm-types")
    ends = rows.agg(F.count_if(train).alias("n")).first()["n"]
    sums = types.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("words"), F.count_if(F.col("c") > 0).alias("kinds")).first()
    tokens, kinds = sums["words"] + ends, sums["kinds"] + (ends > 0)

    pieces, start = load_pieces(vocabulary)
    logp = start
    share = np.exp(start)
    for _ in range(ROUNDS if sums["words"] else 0):
        sent = spark.sparkContext.broadcast(Lattice(pieces, logp))  # of the vocabulary's size

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lattice = sent.value
            total = np.zeros(len(lattice.logp))
            for b in batches:
                lattice.run(b.column("word").to_pylist(), b.column("c").to_numpy().astype(float), total)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "e"])

        got = types.filter("c > 0").select("word", "c").mapInArrow(expect, "piece int, e double").groupBy("piece").agg(F.sum("e").alias("e")).collect()  # at most the vocabulary
        e = np.zeros(len(pieces))
        for r in got:
            e[r["piece"]] = r["e"]
        logp = np.log((e + PRIOR * share) / (e.sum() + PRIOR))
    sent = spark.sparkContext.broadcast(Lattice(pieces, logp))
    n = max(1, sums["words"])
    shared_mass = DISCOUNT * sums["kinds"] / n if sums["words"] else 1.0
    stop = (ends + 1) / (tokens + 2)
    go = math.log10(1 - stop)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = sent.value.run(b.column("word").to_pylist())
            own = np.log(np.maximum(b.column("c").to_numpy() - DISCOUNT, 1e-300) / n)
            mixed = np.logaddexp(paths + math.log(shared_mass), own) / math.log(10) + go
            cols = [b.column("word"), b.column("c"), b.column("n"), pa.array(np.log10(b.column("c").to_numpy() + 1.0)), pa.array(paths / math.log(10) + go), pa.array(mixed)]
            yield pa.RecordBatch.from_arrays(cols, names=["word", "c", "n", "base", "lp", "mixed"])

    known = cut(types.mapInArrow(weigh, "word string, c long, n long, base double, lp double, mixed double"), "lm-words")
    drop_cut(types)
    head = {r["word"].encode("utf-8", "surrogatepass"): (float(r["c"] > 0), r["base"], r["lp"], r["mixed"]) for r in known.orderBy(F.desc("n"), "word").limit(HEAD).collect()}
    shared = spark.sparkContext.broadcast(head)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        names = ["row", "word", "k", "doc_id", "held_out", "n_tokens", "known", "base", "lp", "mixed"]

        def table(rows_, words_, ks, own):
            n = len(own)
            m = len(rows_)
            pad = lambda x, kind: pa.concat_arrays([pa.nulls(m, kind), pa.array(x, kind)])
            cols = list(zip(*own, strict=True)) if n else [()] * 8
            return pa.RecordBatch.from_arrays(
                [pa.array([*rows_, *cols[0]], pa.int64()), pa.concat_arrays([_strings(words_), pa.nulls(n, pa.string())]), pa.array([*ks, *[0] * n], pa.int64()), pad(cols[1], pa.int64()), pad(cols[2], pa.bool_()), pad(cols[3], pa.int64()), pad(cols[4], pa.float64()), pad(cols[5], pa.float64()), pad(cols[6], pa.float64()), pad(cols[7], pa.float64())],
                names=names,
            )

        r, w, k, own = [], [], [], []
        for b in batches:
            for row, doc, out, t in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), b.column("text"), strict=True):
                found = split(t.as_py())
                rare: dict[bytes, int] = {}
                sure = base = lp = mixed = 0.0
                for x in found:
                    h = head.get(x)
                    if h is None:
                        rare[x] = rare.get(x, 0) + 1
                    else:
                        sure += h[0]
                        base += h[1]
                        lp += h[2]
                        mixed += h[3]
                own.append((row, doc, out, len(found) + 1, sure, base, lp, mixed))
                r += [row] * len(rare)
                w += rare
                k += rare.values()
                if len(w) > 50_000:
                    yield table(r, w, k, own)
                    r, w, k, own = [], [], [], []
        if own:
            yield table(r, w, k, own)

    parts = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(spell, "row long, word string, k long, doc_id long, held_out boolean, n_tokens long, known double, base double, lp double, mixed double")
    # words of the texts' own rows are null: they stay apart from the join's keys
    table = known.select("word", (F.col("c") > 0).cast("double").alias("w_known"), F.col("base").alias("w_base"), F.col("lp").alias("w_lp"), F.col("mixed").alias("w_mixed"))
    key = F.coalesce("word", F.concat(F.lit(" "), F.col("row").cast("string")))
    joined = parts.withColumn("word", key).join(table, "word", "left")
    whole = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("known", F.col("k") * F.col("w_known"))).alias("known"), F.sum(F.coalesce("base", F.col("k") * F.col("w_base"))).alias("base"), F.sum(F.coalesce("lp", F.col("k") * F.col("w_lp"))).alias("lp"), F.sum(F.coalesce("mixed", F.col("k") * F.col("w_mixed"))).alias("mixed"),
    )
    floor = math.log10(tokens + kinds + 1)
    end_base, end_lp = math.log10(ends + 1), math.log10(stop)
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + (1 if ends else 0)).cast("long").alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        F.round(F.col("base") + end_base - F.col("n_tokens") * floor, 9).alias("base_score"), F.round(F.col("lp") + end_lp, 9).alias("score"), F.round(F.col("mixed") + end_lp, 9).alias("mixed_score"),
    )
