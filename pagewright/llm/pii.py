"""Personal data by candidate gradient boosting.

Generators propose spans with high recall: addresses and hosts written out ("at", "dot"), and digit
groups of any punctuation. A candidate is labelled by evidence that the base patterns have no part
in: the written-out form normalised, with a common top-level domain or a cue word; part ranges; Luhn;
a digit plan with a cue word or a plus. Boosted trees learn these labels, on the candidates of all
documents, from the format and the text around, without that evidence: candidates are counted by
label and binned features, and these counts are the weights of the trees' rows. A threshold is
calibrated on all candidates held back (one in four, by hash) that overlap no base span, so that 98
of 100 above it are right. Base spans
always stay; a candidate that overlaps none of them and whose score reaches the threshold is added,
except where it has the form of a base match that failed its check.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import cut, drop_cut

KINDS = ["email", "ip", "card", "phone"]
#: Bins of a feature, at quantiles over all candidates.
CUTS = 16
#: Distinct rows of binned features that come to the driver at most (the name is from when these were sampled):
#: where there are more, bins become coarser, down to two a feature; no candidate is left out.
SAMPLE_SPANS = 200_000
PRECISION = 0.98
# fixed values: the base patterns
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A whole chain of numbers with dots; the base pattern for ip takes four of them at a time.
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WRITTEN = re.compile(r"(?: ?(?:\(at\)|\[at\])| at ) ?([A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++)?")
_DIGITS = re.compile(r"\(?[0-9][0-9 ().\-/]{7,}[0-9]")
_HOST = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\(dot\)|\[dot\]|\[\.\]|\(\.\)|\.| dot ) ?[0-9]{1,3}){3}(?![0-9])")
_AT, _DOT = re.compile(r" ?(?:\(at\)|\[at\]| at ) ?"), re.compile(r" ?(?:\(dot\)|\[dot\]|\[\.\]|\(\.\)|\.| dot ) ?")
_TOP = frozenset("com org net edu gov info io de fr es it uk eu us".split())
# the first two are evidence, the others features
_MAIL, _TEL = (re.compile(p, re.I) for p in (r"mail|contact|write|reach", r"tel|phone|call|fax|mobile"))
_CUES = [re.compile(p, re.I) for p in (r"\bip\b|host|server|addr", r"card|visa|pay|iban")]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the base pattern, found from each @ outwards instead of from every letter."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        m = _EMAIL.match(text, a) if a < at else None
        if m:
            out.append(m.span())
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the base rules confirm, by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _CARD.finditer(text):
        # most digit groups are short
        if m.end() - m.start() >= 12:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "." in text:
        for m in _CHAIN.finditer(text):
            parts, at = m.group().split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                    out.append((at, 1, end))
                at = end + 1
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(text: str) -> list[tuple[int, int]]:
    """Addresses written out, found from each "at" outwards, so that the time is linear."""
    out, last = [], 0
    for m in _WRITTEN.finditer(text):
        a = m.start()
        while m.group(1) and a > last and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            out.append((a, m.end()))
            last = m.end()
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything that might be personal data, overlaps included."""
    out = [(a, 0, b) for a, b in written(text)] if "at" in text and "dot" in text else []
    out += [(m.start(), 1, m.end()) for m in _HOST.finditer(text)]
    for m in _DIGITS.finditer(text):
        n = len(_digits(m.group()))
        if 9 <= n <= 19:
            out.append((m.start(), 2 if n >= 12 and "(" not in m.group() else 3, m.end()))
    return out


def failed(span: str) -> bool:
    """Whether a span has the form of a base card or address whose check fails."""
    n = len(_digits(span))
    if _IP.fullmatch(span):
        return any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or "0") > 255 for p in span.split("."))
    return bool(_CARD.fullmatch(span)) and 12 <= n <= 19 and not luhn(_digits(span))


def evidence(text: str, a: int, kind: int, b: int) -> bool:
    """Whether checks that the base patterns have no part in speak for a candidate."""
    span, before = text[a:b], text[max(0, a - 24) : a]
    if failed(span):
        return False
    if kind == 0:
        plain = _DOT.sub(".", _AT.sub("@", span))
        return bool(_EMAIL.fullmatch(plain)) and (plain.rpartition(".")[2].lower() in _TOP or bool(_MAIL.search(before)))
    if kind == 1:
        return all(p.isdigit() and int(p) <= 255 for p in _DOT.sub(".", span).split("."))
    d = _digits(span)
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 and ("+" in text[max(0, a - 5) : a] or bool(_TEL.search(before)))


def features(text: str, a: int, kind: int, b: int) -> list[float]:
    span, before, after = text[a:b], text[max(0, a - 24) : a], text[b : b + 8]
    d = _digits(span)
    return [
        kind, b - a, len(d), span.count(" "), span.count("-"), span.count("."), span.count("(") + span.count(")"), span.count("/"),
        float(9 <= len(d) <= 15), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\n "), float(before[-2:-1] in ":,."), max(len(p) for p in re.split(r"[ ().\-/]", span)),
        float("(at)" in span or "[at]" in span), float("dot" in span), float(span[:1].islower()),
        *[float(bool(c.search(before))) for c in _CUES],
    ]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """For every value the number of its feature's edges below it."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


class Trees:
    """Gradient-boosted regression trees of depth `depth` on quantile cuts, logistic loss."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, cuts: int = 16, least: int = 5):
        self.rounds, self.depth, self.rate, self.cuts, self.least = rounds, depth, rate, cuts, least
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, edges: list[np.ndarray] | None = None) -> Trees:
        """weights: how many examples a row stands for; edges: the cuts of every feature, else quantiles of x."""
        w = np.ones(len(y)) if weights is None else weights.astype(float)
        p = np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        z = np.full(len(y), self.start)
        if edges is None:
            edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.cuts + 1)[1:-1])) for j in range(x.shape[1])]
        bins = binned(x, edges)
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-z))
            tree = self._grow(bins, w * (y - prob), w * prob * (1 - prob), w, edges, np.arange(len(y)), self.depth)
            self.trees.append(tree)
            z += self.rate * self._walk(tree, x)
        return self

    def _grow(self, bins, g, h, w, edges, rows, depth):
        G, H, W = g[rows].sum(), h[rows].sum(), w[rows].sum()
        best = (1e-6, None)
        if depth and W >= 2 * self.least:
            for j, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                gl, hl, n = (np.bincount(bins[rows, j], v[rows], len(cuts) + 1).cumsum()[:-1] for v in (g, h, w))
                gain = np.where((self.least <= n) & (n <= W - self.least), gl**2 / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G**2 / (H + 1), 0)
                c = int(gain.argmax())
                if gain[c] > best[0]:
                    best = (gain[c], (j, c))
        if best[1] is None:
            return float(np.clip(G / (H + 1), -4, 4))
        j, c = best[1]
        left = bins[rows, j] <= c
        return (j, float(edges[j][c]), self._grow(bins, g, h, w, edges, rows[left], depth - 1), self._grow(bins, g, h, w, edges, rows[~left], depth - 1))

    def _walk(self, tree, x):
        if isinstance(tree, float):
            return np.full(len(x), tree)
        j, c, low, high = tree
        left = x[:, j] <= c
        out = np.empty(len(x))
        out[left], out[~left] = self._walk(low, x[left]), self._walk(high, x[~left])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for t in self.trees:
            z += self.rate * self._walk(t, x)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y, free, back = [], [], [], []
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = t.as_py() or ""
            if not (found := candidates(text)):
                continue
            base = base_spans(text)
            for a, k, b in found:
                x.append(features(text, a, k, b))
                y.append(int(evidence(text, a, k, b)))
                back.append(int(zlib.crc32(f"{i}:{a}:{k}:{b}".encode()) % 4 == 0))
                free.append(int(not failed(text[a:b]) and not any(p < b and a < q for p, _, q in base)))
        if x:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), *[pa.array(v, pa.int32()) for v in (y, free, back)]], names=["x", "y", "free", "back"])


def _counted(seen: DataFrame, cuts: int) -> tuple[DataFrame, list[np.ndarray]]:
    """Candidates counted by label and bins of their features, and the borders of the bins."""
    values = seen.select(F.posexplode("x").alias("j", "v"), "n").groupBy("j", "v").agg(F.sum("n").alias("n"))
    at = [k / cuts for k in range(1, cuts)]
    told = {r["j"]: r["q"] for r in values.groupBy("j").agg(F.percentile("v", at, F.col("n")).alias("q")).collect()}
    edges = [np.unique(told[j]) for j in sorted(told)]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bins = binned(np.array(b.column("x").to_pylist()), edges)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in bins], pa.binary()), *[b.column(c) for c in ("y", "free", "back", "n")]], names=["bins", "y", "free", "back", "n"])

    rows = seen.mapInArrow(put, "bins binary, y int, free int, back int, n long")
    return rows.groupBy("bins", "y", "free", "back").agg(F.sum("n").alias("n")), edges


def fit(docs: DataFrame) -> tuple[Trees | None, float]:
    """Trees and threshold, from the candidates of all rows."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_examples, "x array<double>, y int, free int, back int")
    seen = cut(found.groupBy("x", "y", "free", "back").agg(F.count("*").alias("n")), "pii-candidates")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if total["n"] < 50 or total["low"] == total["high"]:
        drop_cut(seen)
        return None, 2.0
    cuts = CUTS
    while True:
        counted, edges = _counted(seen, cuts)
        rows = counted.limit(SAMPLE_SPANS + 1).collect() if cuts > 2 else counted.collect()
        if cuts == 2 or len(rows) <= SAMPLE_SPANS:
            break
        cuts //= 2
    drop_cut(seen)
    rows = sorted((bytes(r["bins"]), r["y"], r["free"], r["back"], r["n"]) for r in rows)
    bins = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).reshape(len(rows), -1)
    y, free, back, n = (np.array([r[k] for r in rows]) for k in range(1, 5))
    # any value of a bin stands for it: its upper border, or one beyond the last
    x = np.stack([np.append(e, e[-1] + 1)[bins[:, j]] for j, e in enumerate(edges)], axis=1)
    back, free = back > 0, free > 0
    if back.all():
        return None, 2.0
    trees = Trees().fit(x[~back], y[~back], n[~back], edges)
    back &= free
    if not back.any():
        return None, 2.0
    s = trees.score(x[back])
    order = np.argsort(-s, kind="stable")
    right = np.cumsum((n * y)[back][order]) / np.cumsum(n[back][order])
    # equal scores stand or fall together
    right[:-1][s[order][:-1] == s[order][1:]] = 0
    good = np.flatnonzero(right >= PRECISION)
    return trees, max(0.5, float(s[order][good[-1]])) if len(good) else 2.0


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and redacted_sha256 of every row.

    Null and empty texts have no spans (base_sha256 of the empty string). Repeated rows and null ids
    are treated like any other row. An empty table gives an empty result; further columns are ignored.
    """
    trees, threshold = fit(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "redacted_sha256")}
            for t in batch.column("text"):
                text = t.as_py() or ""
                base = base_spans(text)
                n = [0, 0, 0, 0]
                for _, k, _ in base:
                    n[k] += 1
                told = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
                more = []
                if trees is not None:
                    free = [c for c in candidates(text) if not failed(text[c[0] : c[2]]) and not any(a < c[2] and c[0] < b for a, _, b in base)]
                    if free:
                        s = trees.score(np.array([features(text, *c) for c in free]))
                        for c, v in sorted(zip(free, s, strict=True), key=lambda p: (-p[1], p[0])):
                            if v >= threshold and not any(a < c[2] and c[0] < b for a, _, b in more):
                                more.append(c)
                spans = sorted([*base, *more])
                red, at = [], 0
                for a, k, b in spans:
                    if a >= at:
                        red.append(text[at:a] + f"[{KINDS[k]}]")
                    at = max(at, b)
                red.append(text[at:])
                for c, v in zip(("n_email", "n_ip", "n_card", "n_phone"), n, strict=True):
                    out[c].append(v)
                out["base_sha256"].append(hashlib.sha256(told.encode()).hexdigest())
                out["spans"].append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans))
                out["n_added"].append(len(more))
                out["redacted_sha256"].append(hashlib.sha256("".join(red).encode("utf-8", "surrogatepass")).hexdigest())
            cols = [pa.array(v, pa.int64() if c.startswith("n_") else pa.string()) for c, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", *out])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, redacted_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, schema)
