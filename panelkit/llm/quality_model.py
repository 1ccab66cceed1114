"""Operator 4, quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text becomes a vector of document statistics; a fixed random map of cosines
makes inner products approximate a Gaussian kernel over these vectors; each
partition sums its part of the normal equations and the sums are added in
groups; the driver solves one small system.  The two learning folds (crc32 of
the doc_id mod 3 is 0 or 2) score each other, and isotonic regression over
those out-of-fold scores turns a raw score into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, slim_texts, table, written
from panelkit.llm.quality_rules import SYMBOLS, Text

FOURIER = 192  # random cosines
RIDGE = 1e-3  # times the number of learning rows
BINS = 1_024  # of the scores that calibration sees
SEED = 20_240
CLIP = 6.0  # standard deviations

NAMES = ("log_words", "log_bytes", "word_length", "word_spread", "distinct_words", "commonest_word", "repeated_windows", "lines_per_word", "duplicate_lines",
         "upper", "digits", "beyond_ascii", "spaces", "full_stops", "commas", "exclamations", "questions", "colons", "quotes", "slashes", "brackets", "equals",
         *(f"symbol_{i}" for i in range(len(SYMBOLS))), "entropy")


def statistics(text: str) -> list[float]:
    """The document statistics of a whole text, in the order of NAMES; an empty text has zeros."""
    import math

    import numpy as np
    t = Text(text)
    raw = text.encode("utf-8", "surrogatepass")
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = t["words"]
    n, size = max(len(words), 1), max(len(raw), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    share = lambda chars: sum(int(h[ord(c)]) for c in chars) / size
    p = h[h > 0] / size
    return [math.log1p(len(words)), math.log1p(len(raw)), float(lengths.mean()), float(lengths.std()), len(set(words)) / n, t["n_commonest"] / n, t["n_repeat_words"] / n,
            t["n_lines"] / n, t["n_dup_lines"] / max(t["n_lines"], 1), float(h[65:91].sum()) / size, float(h[48:58].sum()) / size, float(h[128:].sum()) / size,
            share(" "), share("."), share(","), share("!"), share("?"), share(":;"), share("\"'"), share("/\\"), share("()[]{}"), share("="),
            *(share(c) for c in SYMBOLS), float(-(p * np.log2(p)).sum())]


@dataclass
class Model:
    """Everything is of fixed size, whatever the corpus."""
    mean: list[float]
    scale: list[float]
    weights: list[float] | None  # of the cosines and, last, the constant; None: nothing to learn from
    knots: list[tuple[float, float]]  # raw score, probability; both ascending

    def score(self, x):
        """Probabilities of label 1 for a matrix of statistics."""
        import numpy as np
        if self.weights is None:
            return np.full(len(x), self.knots[0][1])
        raw = fourier(x, self.mean, self.scale) @ np.array(self.weights)
        return np.interp(raw, [a for a, _ in self.knots], [b for _, b in self.knots])


def fourier(x, mean, scale):
    """The random features of a matrix of statistics, the constant last.  The map depends on SEED alone."""
    import numpy as np
    z = np.clip((np.asarray(x, float) - mean) / scale, -CLIP, CLIP)
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((z.shape[1], FOURIER)) / np.sqrt(z.shape[1])  # a kernel as wide as the usual distance
    b = rng.uniform(0, 2 * np.pi, FOURIER)
    return np.hstack([np.sqrt(2 / FOURIER) * np.cos(z @ w + b), np.ones((len(z), 1))])


def features(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` (doc_id if none) and x, the statistics of every whole text; null as empty."""
    keep = keep or ("doc_id",)

    def run(rows):
        for *kept, text in rows:
            yield (*kept, statistics(text))

    kinds = dict(df.dtypes)
    return map_rows(slim_texts(df, *keep), run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", x array<double>")


def fold() -> Column:
    """crc32 of the doc_id as text, mod 3; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))


def learning_rows(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """x, y, fold (0 or 2) of the rows that may be learned from.  Repeated labels of a document are averaged."""
    y = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    return feats.withColumn("fold", fold()).where("fold != 1").join(y, "doc_id").select("x", "y", "fold")


def _sums(rows: DataFrame, one) -> dict:
    """``one(x, y) -> 1-D array`` summed over partitions and folds: {fold: array}.

    A partition sends one array per fold; these are added in groups of partitions, and the driver gets at most 16 a fold.
    """
    def part(batches):
        import numpy as np
        import pandas as pd
        sums = {}
        for b in batches:
            for f, g in b.groupby("fold"):
                for at in range(0, len(g), 4096):
                    v = one(np.vstack(g["x"].iloc[at:at + 4096].to_numpy()), g["y"].iloc[at:at + 4096].to_numpy(float))
                    sums[f] = sums.get(f, 0) + v
        yield pd.DataFrame({"fold": list(sums), "v": [v.tobytes() for v in sums.values()]})

    def add(pdf):
        import numpy as np
        import pandas as pd
        total = sum(np.frombuffer(v) for v in pdf["v"])
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "v": [total.tobytes()]})

    import numpy as np
    parts = rows.mapInPandas(part, "fold long, v binary").withColumn("g", F.pmod(F.monotonically_increasing_id() / (1 << 33), F.lit(16)).cast("int"))
    out: dict = {}
    for r in parts.groupBy("fold", "g").applyInPandas(add, "fold long, v binary").collect():
        out[r["fold"]] = out.get(r["fold"], 0) + np.frombuffer(bytes(r["v"]))
    return out


def fit(feats: DataFrame, labels: DataFrame) -> Model:
    """The model from all labelled rows of the learning folds.  No such rows: a constant score of a half."""
    import numpy as np
    rows = learning_rows(feats, labels)
    rows = written(rows, "quality-learning")
    moments = _sums(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)]))
    if not moments:
        return Model([0.0] * len(NAMES), [1.0] * len(NAMES), None, [(0.0, 0.5)])
    n, positive, *rest = sum(moments.values())
    k = len(NAMES)
    mean = np.array(rest[:k]) / n
    scale = np.sqrt(np.maximum(np.array(rest[k:]) / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    mean, scale = mean.tolist(), scale.tolist()

    def normal(x, y):
        phi = fourier(x, mean, scale)
        return np.concatenate([(phi.T @ phi).ravel(), phi.T @ y])

    sums, d = _sums(rows, normal), FOURIER + 1

    def solve(folds):
        total = sum(sums[f] for f in folds)
        m = sum(moments[f][0] for f in folds)
        return np.linalg.solve(total[:d * d].reshape(d, d) + RIDGE * m * np.eye(d), total[d * d:])

    whole = solve(list(sums))
    other = {f: solve([g for g in sums if g != f] or [f]) for f in sums}  # scores a fold by the other one
    return Model(mean, scale, whole.tolist(), calibrate(rows, mean, scale, other))


def calibrate(rows: DataFrame, mean, scale, weights: dict) -> list[tuple[float, float]]:
    """Knots of the isotonic regression of labels on out-of-fold scores, from at most BINS + 2 counted bins."""
    def run(batches):
        import numpy as np
        import pandas as pd
        for b in batches:
            if len(b):
                phi = fourier(np.vstack(b["x"].to_numpy()), mean, scale)
                raw = np.zeros(len(b))
                for f, w in weights.items():
                    here = (b["fold"] == f).to_numpy()
                    raw[here] = phi[here] @ w
                yield pd.DataFrame({"bin": np.clip(np.floor(raw * BINS), -1, BINS).astype("int64"), "y": b["y"].astype(float)})

    got = rows.mapInPandas(run, "bin long, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("s")).orderBy("bin").collect()
    blocks: list[list[float]] = []  # rows, sum of labels, sum of bin centres
    for r in got:
        blocks.append([r["n"], r["s"], r["n"] * (r["bin"] + 0.5) / BINS])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return [(c / n, s / n) for n, s, c in blocks]


def scored(feats: DataFrame, model: Model) -> DataFrame:
    """The rows of ``feats`` with score in place of x."""
    @F.pandas_udf("double")
    def score(x):
        import numpy as np
        import pandas as pd
        return pd.Series(model.score(np.vstack(x.to_numpy())) if len(x) else [], dtype=float)

    return feats.withColumn("score", score("x")).drop("x")


def keep_good(df: DataFrame, model: Model) -> DataFrame:
    """The rows whose text scores a half or more, all columns as they are."""
    @F.pandas_udf("boolean")
    def good(texts):
        import numpy as np
        import pandas as pd
        return pd.Series(model.score(np.array([statistics(t or "") for t in texts])) >= 0.5 if len(texts) else [], dtype=bool)

    return df.where(good("text"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = written(features(table(spark, sf_dir, "documents")), "quality-features")
    model = fit(feats, table(spark, sf_dir, "labels"))
    return scored(feats, model).select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
