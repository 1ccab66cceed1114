"""Inputs that the operators must take: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: A few names that operators use for their outputs or inside.
CLASH = ("shard", "slot", "key", "tie", "row", "n", "x", "score", "kept", "spans", "ids", "part", "block", "offset", "size", "class_id", "component_id", "bucket", "words", "at", "fold", "start", "__row", "__kept", "__at")


def prose(rng, n):
    return " ".join("".join(rng.choice(("th", "er", "on", "an", "re", "he", "in", "ed", "é", "nd")) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def rows(seed=7, n=40):
    rng = random.Random(seed)
    out = [(i, prose(rng, rng.randint(1, 120)), "en", "src0", None) for i in range(n)]
    passage = prose(rng, 60)
    out += [
        (100, None, None, None, None), (101, "", "en", "s", 0), (102, " \n\t ", "en", "s", 4), (None, "No id here, but a text.", None, None, None),
        (103, out[3][1], "en", "s", None), (104, out[3][1], "en", "s", None), (104, out[3][1], "en", "s", None),  # copies and a repeated row
        (105, "a" * 30_000, "en", "s", None), (106, prose(rng, 9_000), "en", "s", None), (107, "  two  spaces \n\n and more \t tabs  ", "en", "s", None),
        (108, "I'll say <|endoftext|> 12345 !!! éàü 漢字 🙂🙂 é ﬁ Σας ΟΔΟΣ İ ǅ ²½ ‍ x\x00y", "xx", "s", None), (109, "x", "en", "s", 1),
        (110, prose(rng, 30) + " " + passage + " " + prose(rng, 30), "en", "s", None), (111, passage + prose(rng, 10), "en", "s", None), (112, "\n".join([passage] * 4), "en", "s", None),
    ]
    return out


def docs(spark, clash=True, seed=7):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows(seed), DOCS).repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH]) if clash else df


def empty(spark):
    return spark.createDataFrame([], DOCS)
