"""Patterns of texts, against the plain forms of their rules."""

import random
import re

from pyspark.sql import functions as F

from pagewright.functions import exprs as X

EDGE, END = "(?:^|[^A-Z0-9_])", "(?:[^A-Z0-9_]|$)"
RULES = [f"{EDGE}[0-9]{{4}}{END}", f"{EDGE}(?:JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC){END}", "[0-9]+%", r"\$[0-9]+", rf"{EDGE}[0-9]+\.[0-9]+{END}", f"{EDGE}[0-9]+[KMB]{END}"]
BLANKS = " \t\n\r\f\x0b"


def test_patterns_by_rule(spark):
    """F8: a border that is no blank of ours stays, so a text that ends in one counts whole; all else as the rules say."""
    rng = random.Random(8)
    bits = ["1", "20", "2024", "199", ".", "%", "$", "k", "M", "b", "may", "Dec", "dec1", "_", " ", "  ", "\n", "\t", "x", "é", "word", "-", " "]
    texts = ["".join(rng.choices(bits, k=rng.randrange(9))) for _ in range(3000)] + ["x  ", "x \x85", "a\r\n", "\x0b", "x" + " " * 300_000 + "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.p for r in df.select("i", X.text_patterns(F.col("t")).alias("p")).orderBy("i").collect()]
    for t, p in zip(texts, got, strict=True):
        words = len(re.findall("[^ \t\n\r\f\x0b]+", t))
        bare, many = t.strip(BLANKS), t.count("\n") > 0 and t.count("\n") / max(words, 1) > 0.3
        visual = any(re.search(r, t.upper()) for r in RULES)
        assert (p.is_empty, p.many_lines, p.visual, p.n_chars, p.n_words) == (bare == "", many, visual, len(bare), words), t[:50]
        assert p.suggests_visual == (bare != "" and (many or (visual and len(bare) < 50))), t[:50]
