"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are the 1- to 4-grams of its lower-cased letters, with every run of
other characters as one blank. Each is hashed to a row of an embedding table; the rows
are averaged and a linear layer with softmax gives the languages. Both layers are
trained by stochastic gradient descent in numpy on a bounded sample of labelled
documents (``sample`` rows, as many of each language as there are or as an equal share allows,
chosen by hash among distinct texts; the bound is a parameter). Each step takes a random stretch
of a whole text. A part of the sample is held back: it gives the temperature of the softmax and the score under which
a document is rejected.

At prediction time embedding and linear layer are multiplied into one table, so that a
text costs one look-up for each subword. Whole texts are used, in blocks of whole texts.

Defined results: null text or text without a letter gives ``und``, score 0, rejected;
without any labelled document everything is ``und``; the empty string is a label like any other; rows with a null doc_id are
held in (their remainder is null); other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
DIMENSION = 16
SAMPLE = 4000
BLOCK_CHARS = 400_000
#: Parts of one language in which its sample is looked for.
PARTS = 64


def _letters() -> np.ndarray:
    """For each code point of the basic plane, itself if a letter, else a blank."""
    out = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if unicodedata.category(chr(c))[0] in "LM":
            out[c] = c
    return out


_table: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    """Letters of the text as code points, other runs as one blank, with a blank at both ends."""
    if not _table:
        _table.append(_letters())
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _table[0][np.minimum(c, 0xFFFF)]
    if c.max() > 0xFFFF:
        for at in np.flatnonzero(c > 0xFFFF):
            low[at] = c[at] if unicodedata.category(chr(c[at]))[0] in "LM" else 32
    blank = low == 32
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    return low[keep]


def subwords(codes: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(order, bucket of the subword that starts at each place)."""
    h = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            return
        h = h[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]
        if n in ORDERS:
            x = h * np.uint32(0x85EBCA6B) + np.uint32(n)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x9E3779B1)
            yield n, (x >> np.uint32(8)) % np.uint32(buckets)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


class Model:
    """``table``: for each bucket, the logits that one subword adds; ``temperature``, ``floor``: calibration."""

    def __init__(self, langs: list[str], table: np.ndarray, temperature: float = 1.0, floor: float = 0.0):
        self.langs, self.table, self.temperature, self.floor = langs, table, temperature, floor

    def logits(self, texts: list[str]) -> np.ndarray:
        """Mean of the table's rows over each text's subwords; blocks of whole texts share one pass."""
        out = np.zeros((len(texts), self.table.shape[1]))
        at = 0
        while at < len(texts):
            parts, n, first = [], 0, at
            while at < len(texts) and (not parts or n < BLOCK_CHARS):
                parts.append(_codes(texts[at]))
                n += len(parts[-1])
                at += 1
            sizes = np.array([len(p) for p in parts])
            codes, ends = np.concatenate(parts), np.cumsum(sizes)
            starts, total = ends - sizes, np.zeros(len(parts))
            for order, b in subwords(codes, len(self.table)):
                # Subwords that run over a text's end belong to no text.
                good = np.ones(len(b), bool)
                for back in range(1, order):
                    e = ends - back
                    good[e[(e >= 0) & (e < len(b))]] = False
                rows = self.table[b]
                rows[~good] = 0
                has = starts < len(b)
                out[first:at][has] += np.add.reduceat(rows, starts[has], axis=0, dtype=np.float64)
                total += np.maximum(sizes - order + 1, 0)
            out[first:at] /= np.maximum(total, 1)[:, None]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        known = [k for k, t in enumerate(texts) if self.langs and has_letter(t)]
        lang, score, out = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if known:
            p = softmax(self.logits([texts[k] for k in known]) / self.temperature)
            best = p.argmax(1)
            score[known] = p[np.arange(len(best)), best]
            out[known] = score[known] < self.floor
            for k, b in zip(known, best, strict=True):
                lang[k] = self.langs[b]
        return lang, score, out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(rows: list[tuple[str, str]], buckets: int = BUCKETS, dimension: int = DIMENSION, steps: int = 20_000, rate: float = 0.5, reject: float = 0.001, seed: int = 1) -> Model:
    """Train on (text, lang) rows in about ``steps`` steps: every fifth row is kept for calibration.

    ``reject``: share of the calibration rows that the floor may reject.
    """
    langs = sorted({lang for _, lang in rows})
    rows = [(t, lang) for t, lang in rows if has_letter(t)]
    if not rows:
        return Model([], np.zeros((buckets, 1), np.float32))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / dimension, (buckets, dimension)).astype(np.float32)
    linear = np.zeros((dimension, len(langs)), np.float32)
    held = [r for k, r in enumerate(rows) if k % 5 == 4] or rows
    train = [r for k, r in enumerate(rows) if k % 5 != 4]
    y = [langs.index(lang) for _, lang in train]

    def piece(t: str, size: int) -> np.ndarray:
        at = int(rng.integers(0, max(1, len(t) - size + 1)))
        return np.concatenate([b for _, b in subwords(_codes(t[at : at + size]), buckets)])

    # As many steps whatever the sample: small ones are gone through more often.
    epochs = -(-steps // len(train))
    n = epochs * len(train)
    step = 0
    for _ in range(epochs):
        for k in rng.permutation(len(train)):
            # Short and long stretches alike, so that short documents are known as well.
            b = piece(train[k][0], int(rng.choice([20, 60, 200, 1000])))
            lr = rate * (1 - step / n)
            step += 1
            mean = embed[b].mean(0)
            g = softmax((mean @ linear)[None].astype(np.float64))[0]
            g[y[k]] -= 1
            g = g.astype(np.float32)
            back = linear @ g
            linear -= lr * np.outer(mean, g)
            np.subtract.at(embed, b, (lr / len(b) * 20) * back)
    model = Model(langs, (embed @ linear).astype(np.float32))
    logits = model.logits([t for t, _ in held])
    truth = np.array([langs.index(lang) for _, lang in held])

    def loss(temperature: float) -> float:
        p = softmax(logits / temperature)
        return -float(np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean())

    model.temperature = min((0.1 * 1.25**k for k in range(25)), key=loss)
    score = softmax(logits / model.temperature).max(1)
    # Never above one half: a document whose language leads clearly stays.
    model.floor = float(min(np.quantile(score, reject), 0.5))
    return model


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, **options) -> Model:
    """Fit on at most ``sample`` labelled rows (one for each language, if there are more languages), whole texts.

    Every language has its share, so a rare one is learnt at any size of the table; a text that is there
    many times is one row of the sample.
    """
    own = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    # Only hashes are grouped and ranked; the texts of the chosen rows follow.
    hashed = own.select("l", F.xxhash64(F.lit("lang"), F.col("t")).alias("h")).distinct()
    langs = hashed.agg(F.count_distinct("l")).first()[0]
    if not langs:
        return fit([])
    share = max(1, sample // langs)
    # The smallest hashes of a language are found in parts first, so that no task ranks a whole language.
    part = F.row_number().over(Window.partitionBy("l", F.pmod("h", F.lit(PARTS))).orderBy("h"))
    some = hashed.withColumn("r", part).where(F.col("r") <= share).withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("h"))).where(F.col("r") <= share)
    chosen = F.broadcast(some.select(F.col("l").alias("cl"), F.col("h").alias("ch")))
    rows = own.withColumn("h", F.xxhash64(F.lit("lang"), F.col("t"))).join(chosen, F.expr("l = cl and h = ch")).groupBy("l", "h").agg(F.min("t").alias("t"))
    return fit([(r.t, r.l) for r in sorted(rows.select("h", "l", "t").collect())], **options)


def predictor(spark: SparkSession, model: Model):
    """A function from a text column to a struct (lang_pred, score, rejected)."""
    sent = spark.sparkContext.broadcast(model.__dict__)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(**sent.value)
        for some in texts:
            lang, score, out = model.predict([t if isinstance(t, str) else None for t in some])
            yield pd.DataFrame({"lang_pred": lang, "score": score, "rejected": out})

    return run


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, lang_pred, score, rejected; one row for each row of ``docs``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), predictor(docs.sparkSession, model)(F.col(text)).alias("p"))
    return own.select("doc_id", "p.*")


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language the model does not reject."""
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predictor(docs.sparkSession, model)(F.col(text)).alias("p"))
    return judged.where(~F.col("p.rejected")).select("row.*")


def remainder(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(F.coalesce(remainder() != 2, F.lit(True))))
    return predict(docs, model).select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
