"""Documents with all the awkward rows: NULLs, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["sha", "level", "name", "_row", "_n", "_i", "h", "seg", "label", "size", "taken", "key", "word", "place", "_text", "n", "shard", "pos", "block", "_rank"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "the", "re", "ou", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def sentences(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, rng.randint(3, 9)).capitalize() + rng.choice([".", "!", ".\n"]) for _ in range(n))


def rows(seed: int = 7, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    texts = [sentences(rng, rng.randint(1, 25)) for _ in range(n)]
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "b", "b", None]), len(t)) for i, t in enumerate(texts)]
    for i in range(n, n + 15):  # exact copies, copies in another layout, near copies, shared passages
        base = texts[i % 7]
        edited = base.split(" ")
        if len(edited) > 30:
            edited[3] = "changed"
        kind = [base, base.replace(" ", "\n\t"), " ".join(edited), texts[1][:200] + " " + texts[i % 20], base.upper()][i % 5]
        out.append((i, kind, "en", "b", len(kind)))
    out += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n", "en", "a", 3), (103, "x", "en", "a", 1), (104, "X", "en", "a", 1)]
    out += [(105, "ab " * 9000, "en", "c", 27000), (106, "日本語 ünï 😀. " * 40, "ja", "c", 10), (None, texts[0], "en", "a", 5), (None, None, None, None, None)]
    out += [out[3], out[3], (101, "", "en", "a", 0)]
    return out


def documents(spark, data=None, extra: bool = True):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if extra else df
