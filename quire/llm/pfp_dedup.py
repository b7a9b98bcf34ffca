"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash runs over all windows of 48 bytes. A window is a trigger if its hash is the
smallest among the windows of some 100-byte string around it, so every 100-byte string
holds a trigger, and equal strings hold equal triggers at equal places. Around each trigger
stands a phrase: all bytes that a 100-byte string with this trigger can reach.
The dictionary has the distinct phrases with their first place in the corpus, the parse
has the places of all phrases. Sorted by trigger, phrase and place they give, in corpus
order, what repeats:

- a phrase that stands earlier: all its 100-byte strings repeat;
- the first place of a phrase whose trigger no other phrase has: none repeats;
- the rest, the dictionary phrases that share a trigger: their 100-byte strings are
  ranked among each other, and those that an earlier phrase has repeat.

Only the first and third kinds go on, so unique text costs one hash row for each 25 bytes
and is never sent whole. Rows travel packed by hash bucket, with copies inside a
block resolved before the shuffle. Triggers with very many phrases are dealt by the 100-byte
strings instead, so none has to fit in one task. What is called equal agrees in two 64-bit
hashes: phrases in their trigger's and their own, strings in their trigger's and their own.

Defined results: null text is empty; texts under 100 bytes lose nothing; a null doc_id comes
first; rows that share a doc_id, null ones too, are told apart and ordered by two 64-bit hashes of their texts, and equal
ones are one document given twice; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import discard, global_rank, materialise, release

SPAN = 100
GRAM = 48
LEFT = SPAN - GRAM
#: Bytes of text hashed at a time; bytes of text, phrases and strings for one bucket.
BLOCK = 1 << 20
BUCKET_BYTES = 24 << 20
BUCKET_PHRASES = 15_000
#: A trigger with more distinct phrases than this is dealt by strings.
MANY_PHRASES = 4000
_MARGIN = 2 * SPAN
_BASE = 0x9E3779B97F4A7C15
U = np.uint64

PARTS = (("trigger", "<u8"), ("phrase", "<u8"), ("doc", "<i8"), ("th", "<i4"), ("pos", "<i4"), ("left", "u1"), ("right", "u1"))
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(8, (n - 1).bit_length())
    if size not in _tables:
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _tables[size] = (out[0], out[1])
    return _tables[size]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return (h ^ (h >> U(29))) * U(0xC2B2AE3D27D4EB4F)


def _slide(f, x: np.ndarray, w: int) -> np.ndarray:
    """f over all windows of ``w`` entries."""
    cur, span = x, 1
    while span * 2 <= w:
        cur, span = f(cur[:-span], cur[span:]), span * 2
    n = len(x) - w + 1
    return f(cur[:n], cur[w - span : w - span + n]) if span < w else cur


def pack(cols: dict[str, np.ndarray], at: np.ndarray, parts: tuple = PARTS) -> bytes:
    return b"".join(cols[name][at].astype(kind).tobytes() for name, kind in parts)


def unpack(blobs: list[bytes], parts: tuple = PARTS) -> dict[str, np.ndarray]:
    width = sum(np.dtype(k).itemsize for _, k in parts)
    out: dict[str, list] = {name: [] for name, _ in parts}
    for b in blobs:
        n, at = len(b) // width, 0
        for name, kind in parts:
            out[name].append(np.frombuffer(b, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(out[name]) if out[name] else np.zeros(0, kind) for name, kind in parts}


class Block:
    """Pieces of documents, hashed together. Long documents come in pieces that overlap."""

    def __init__(self) -> None:
        self.pieces: list[tuple] = []
        self.size = 0

    def add(self, doc: int, th: int, raw: bytes) -> Iterator[Block]:
        """Take in a document; yields itself whenever it is full, then starts anew."""
        for core in range(0, len(raw), BLOCK):
            lo, hi = max(0, core - _MARGIN), min(len(raw), core + BLOCK + _MARGIN)
            self.pieces.append((doc, th, lo, len(raw), raw[lo:hi], core - lo, min(core + BLOCK, len(raw)) - lo))
            self.size += hi - lo
            if self.size >= BLOCK:
                yield self
                self.__init__()

    def triggers(self) -> dict[str, np.ndarray]:
        """All triggers of the block's pieces with their phrases."""
        doc, th, base, total, raws, lo, hi = zip(*self.pieces, strict=True)
        buf = np.frombuffer(b"".join(raws), np.uint8)
        n = len(buf)
        size = np.array([len(r) for r in raws], np.int64)
        off = np.concatenate([[0], np.cumsum(size)])
        up, down = _powers(n + 1)
        pre = np.zeros(n + 1, U)
        np.cumsum((buf.astype(U) + U(1)) * up[:n], out=pre[1:])
        h = mix((pre[GRAM:] - pre[: n - GRAM + 1]) * down[: n - GRAM + 1]) | U(1)
        least = _slide(np.minimum, h, LEFT + 1)
        # Strings that run over the end of a piece are none.
        for e in off[1:-1]:
            least[max(0, e - SPAN + 1) : e] = 0
        pad = np.zeros(LEFT, U)
        at = np.flatnonzero(_slide(np.maximum, np.concatenate([pad, least, pad]), LEFT + 1) == h)
        piece = np.searchsorted(off, at, "right") - 1
        local = at - off[piece]
        core = (local >= np.array(lo)[piece]) & (local < np.array(hi)[piece])
        at, piece, local = at[core], piece[core], local[core]
        pos = local + np.array(base, np.int64)[piece]
        left = np.minimum(LEFT, pos)
        right = np.minimum(SPAN, np.array(total, np.int64)[piece] - pos)
        phrase = mix((pre[at + right] - pre[at - left]) * down[at - left] + (left * 1000 + right).astype(U))
        return {"trigger": h[at], "phrase": phrase, "doc": np.array(doc, np.int64)[piece], "th": np.array(th, np.int64)[piece], "pos": pos, "left": left, "right": right}


def _documents(it: Iterator[pd.DataFrame]) -> Iterator[Block]:
    block = Block()
    for pdf in it:
        for doc, th, text in zip(pdf["doc"], pdf["th"], pdf["text"], strict=True):
            raw = text.encode("utf-8", "replace") if text else b""
            if len(raw) >= SPAN:
                yield from block.add(doc, th, raw)
    if block.pieces:
        yield block


def _own(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, doc, th, text): doc and th tell different documents apart.

    th is 0 where one row has the doc_id. Rows that share one, as all null ones do, are told apart by two 64-bit hashes of their texts, by
    whose order they are numbered; beyond 2**31 numbers null doc_ids go on with the next ``doc``.
    """
    low = F.lit(-(2**63)).cast("long")
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), low).alias("doc"), F.col(f"`{text}`").alias("text"))
    shared = materialise(own.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "shared")
    alone = own.select("doc_id", "doc", F.lit(0).alias("th"), "text")
    if not shared.limit(1).count():
        return alone
    t = F.coalesce("text", F.lit(""))
    several = own.join(shared, "doc", "left_semi").withColumns({"h1": F.xxhash64(t), "h2": F.xxhash64(F.lit("again"), t)})
    different = materialise(several.select("doc", "h1", "h2").distinct(), "different")
    numbers = materialise(global_rank(different, F.col("doc"), F.col("h1"), F.col("h2"), name="n"), "numbers")
    more = F.when(F.col("doc_id").isNull(), F.shiftright("n", 31)).otherwise(F.lit(0))
    told = several.join(numbers, ["doc", "h1", "h2"]).select("doc_id", (F.col("doc") + more).alias("doc"), F.col("n").bitwiseAND(F.lit(2**31 - 1)).cast("int").alias("th"), "text")
    return alone.join(shared, "doc", "left_anti").unionByName(materialise(told, "told"))


def _places(c: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Order by trigger, phrase and place; a place that is there twice, from a repeated row, counts once."""
    keys = (c["pos"], c["th"], c["doc"], c["phrase"], c["trigger"])
    order = np.lexsort(keys)
    twice = np.ones(max(0, len(order) - 1), bool)
    for k in keys:
        twice &= k[order[1:]] == k[order[:-1]]
    if not twice.any():
        return order, c
    c = {k: v[np.sort(order[np.concatenate([[True], ~twice])])] for k, v in c.items()}
    return np.lexsort((c["pos"], c["th"], c["doc"], c["phrase"], c["trigger"])), c


def _present(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its places, in order) of the buckets that occur, so that the work does not grow with their number."""
    order = np.argsort(bucket, kind="stable")
    own, first = np.unique(bucket[order], return_index=True)
    yield from zip(own.tolist(), np.split(order, first[1:]) if len(own) else [], strict=True)


def parse(own: DataFrame, buckets: int) -> DataFrame:
    """(bucket, firsts, again): packed triggers, by trigger; those whose phrase stands earlier in the same block, by document."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _documents(it):
            c = block.triggers()
            order, c = _places(c)
            t, p = c["trigger"][order], c["phrase"][order]
            known = np.concatenate([[False], (t[1:] == t[:-1]) & (p[1:] == p[:-1])]) if len(order) else np.zeros(0, bool)
            again = np.zeros(len(order), bool)
            again[order] = known
            bucket = ((c["trigger"] >> U(33)) % U(buckets)).astype(np.int64)
            bucket[again] = (mix(c["doc"].astype(U))[again] >> U(33)) % U(buckets)
            order = np.lexsort((c["pos"], c["doc"]))
            rows = []
            for b, places in _present(bucket[order]):
                at = order[places]
                rows.append((b, pack(c, at[~again[at]]), pack(c, at[again[at]], PARTS[2:])))
            yield pd.DataFrame(rows, columns=["bucket", "firsts", "again"])

    return own.select("doc", "th", "text").mapInPandas(run, "bucket long, firsts binary, again binary")


PLACES = "doc long, th int, start int, stop int, trigger long, kind int"


def dictionary(parsed: DataFrame) -> DataFrame:
    """Places by kind: 0, bytes start to stop repeat; 1 and 2, the first place (start) of a phrase that shares its trigger with few or many others."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        again = unpack(pdf["again"].tolist(), PARTS[2:])
        order, c = _places(unpack(pdf["firsts"].tolist()))
        c = {k: v[order] for k, v in c.items()}
        t, p = c["trigger"], c["phrase"]
        same = np.concatenate([[False], t[1:] == t[:-1]]) if len(t) else np.zeros(0, bool)
        first = ~(same & np.concatenate([[False], p[1:] == p[:-1]])) if len(t) else same
        at = np.flatnonzero(first)
        group = np.cumsum(~same[at]) - 1
        n = np.bincount(group, minlength=1)[group] if len(at) else group
        full = ~first
        need, n = at[n > 1], n[n > 1]
        cat = lambda k: np.concatenate([c[k][full], again[k]]).astype(np.int64)
        done = pd.DataFrame({"doc": cat("doc"), "th": cat("th"), "start": cat("pos") - cat("left"), "stop": cat("pos") + cat("right"), "trigger": 0, "kind": 0})
        todo = pd.DataFrame({"doc": c["doc"][need], "th": c["th"][need], "start": c["pos"][need], "stop": 0, "trigger": c["trigger"][need].view(np.int64), "kind": np.where(n > MANY_PHRASES, 2, 1)})
        return pd.concat([done, todo])

    return parsed.groupBy("bucket").applyInPandas(run, PLACES)


_PHRASE = (("trigger", "<u8"), ("doc", "<i8"), ("th", "<i4"), ("pos", "<i4"), ("left", "u1"), ("right", "u1"))
_STRING = (("key", "<u8"), ("trigger", "<u8"), ("doc", "<i8"), ("th", "<i4"), ("pos", "<i4"), ("left", "u1"))
_ROOM = LEFT + SPAN


def _strings(raw: np.ndarray, c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes before the trigger, key) of every 100-byte string of the phrases in the rows of ``raw``, triggers at column LEFT."""
    up, down = _powers(_ROOM + 1)
    pre = np.zeros((len(raw), _ROOM + 1), U)
    np.cumsum((raw.astype(U) + U(1)) * up[:_ROOM], axis=1, out=pre[:, 1:])
    begin = np.arange(LEFT + 1)
    h = (pre[:, begin + SPAN] - pre[:, begin]) * down[begin]
    before = LEFT - begin
    key = mix(h ^ mix(c["trigger"][:, None] + before.astype(U)))
    good = (before <= c["left"][:, None]) & (SPAN - before <= c["right"][:, None])
    row, col = np.nonzero(good)
    return row, before[col], key[row, col]


def fetch(own: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """(bucket, phrases, raw, strings): the bytes of the phrases to be ranked, packed by trigger; strings of crowded triggers, by string."""
    wanted = places.where("kind > 0").groupBy("doc", "th").agg(F.collect_list(F.struct("start", "trigger", "kind")).alias("w"))
    rows = own.select("doc", "th", "text").join(wanted, ["doc", "th"])

    def emit(c: dict[str, np.ndarray], raw: np.ndarray, kind: np.ndarray) -> pd.DataFrame:
        out = []
        few = np.flatnonzero(kind == 1)
        bucket = ((c["trigger"][few] >> U(33)) % U(buckets)).astype(np.int64)
        for b, places in _present(bucket):
            at = few[places]
            out.append((b, pack(c, at, _PHRASE), raw[at].tobytes(), b""))
        many = np.flatnonzero(kind == 2)
        if len(many):
            own = {k: v[many] for k, v in c.items()}
            row, before, key = _strings(raw[many], own)
            s = {"key": key, "trigger": own["trigger"][row], "doc": own["doc"][row], "th": own["th"][row], "pos": own["pos"][row], "left": before}
            bucket = ((key >> U(33)) % U(buckets)).astype(np.int64)
            out += [(b, b"", b"", pack(s, places, _STRING)) for b, places in _present(bucket)]
        return pd.DataFrame(out, columns=["bucket", "phrases", "raw", "strings"])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols: dict[str, list] = {k: [] for k, _ in _PHRASE}
        raws, kinds, n = [], [], 0

        def flush() -> pd.DataFrame:
            c = {k: np.concatenate([np.asarray(v, d) for v in cols[k]]) for k, d in _PHRASE}
            out = emit(c, np.concatenate(raws), np.concatenate(kinds))
            for v in cols.values():
                v.clear()
            raws.clear()
            kinds.clear()
            return out

        for pdf in it:
            for doc, th, text, w in zip(pdf["doc"], pdf["th"], pdf["text"], pdf["w"], strict=True):
                b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                pos = np.array([x["start"] for x in w], np.int64)
                padded = np.concatenate([np.zeros(LEFT, np.uint8), b, np.zeros(SPAN, np.uint8)])
                raws.append(padded[pos[:, None] + np.arange(_ROOM)])
                kinds.append(np.array([x["kind"] for x in w]))
                for k, v in (("trigger", np.array([x["trigger"] for x in w], np.int64).view(U)), ("doc", np.full(len(pos), doc)), ("th", np.full(len(pos), th)), ("pos", pos), ("left", np.minimum(LEFT, pos)), ("right", np.minimum(SPAN, len(b) - pos))):
                    cols[k].append(v)
                n += len(pos)
                if n >= 20_000:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    return rows.mapInPandas(run, "bucket long, phrases binary, raw binary, strings binary")


def rank(fetched: DataFrame) -> DataFrame:
    """(doc, th, start, stop): bytes of the fetched phrases that an earlier phrase repeats."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        c = unpack(pdf["phrases"].tolist(), _PHRASE)
        s = unpack(pdf["strings"].tolist(), _STRING)
        raw = np.frombuffer(b"".join(pdf["raw"]), np.uint8).reshape(-1, _ROOM)
        parts = []
        # Phrases of one trigger stay together; some triggers at a time.
        order = np.argsort(c["trigger"], kind="stable")
        t = c["trigger"][order]
        at = 0
        while at < len(order):
            to = np.searchsorted(t, t[min(at + BUCKET_PHRASES, len(t)) - 1], "right")
            own = {k: v[order[at:to]] for k, v in c.items()}
            row, before, keys = _strings(raw[order[at:to]], own)
            parts.append(repeats(keys, own["trigger"][row], own["doc"][row], own["th"][row], own["pos"][row], before))
            at = to
        if len(s["key"]):
            parts.append(repeats(s["key"], s["trigger"], s["doc"], s["th"], s["pos"], s["left"].astype(np.int64)))
        parts = parts or [pd.DataFrame({"doc": [], "th": [], "start": [], "stop": []}).astype("int64")]
        return pd.concat(parts)

    return fetched.groupBy("bucket").applyInPandas(run, "doc long, th int, start int, stop int")


def repeats(key: np.ndarray, trigger: np.ndarray, doc: np.ndarray, th: np.ndarray, pos: np.ndarray, before: np.ndarray) -> pd.DataFrame:
    """Bytes covered by the strings whose key and trigger stand earlier, as runs."""
    order = np.lexsort((pos, th, doc, trigger, key))
    if len(order):
        k, t, d, h, p = key[order], trigger[order], doc[order], th[order], pos[order]
        twice = (k[1:] == k[:-1]) & (t[1:] == t[:-1]) & (d[1:] == d[:-1]) & (h[1:] == h[:-1]) & (p[1:] == p[:-1])
        order = order[np.concatenate([[True], ~twice])]
    k, t = key[order], trigger[order]
    dup = order[1:][(k[1:] == k[:-1]) & (t[1:] == t[:-1])]
    doc, th, start = doc[dup], th[dup], pos[dup].astype(np.int64) - before[dup]
    order = np.lexsort((start, th, doc))
    doc, th, start = doc[order], th[order], start[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (start[1:] > start[:-1] + SPAN)]) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]])[: len(first)] - 1
    return pd.DataFrame({"doc": doc[first], "th": th[first], "start": start[first], "stop": start[last] + SPAN})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, n_bytes, spans (array of start, stop: maximal removed runs of bytes), kept (binary); one row for each row of ``docs``."""
    own = _own(docs, doc_id, text)
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = materialise(dictionary(parse(own, max(1, math.ceil(total / BUCKET_BYTES)))), "places")
    release(docs.sparkSession)
    n = places.where("kind > 0").count()
    partial = materialise(rank(fetch(own, places, max(1, math.ceil(n / BUCKET_PHRASES)))), "partial")
    release(docs.sparkSession)
    runs = places.where("kind = 0").select("doc", "th", "start", "stop").unionByName(partial)
    lists = runs.groupBy("doc", "th").agg(F.collect_list("start").alias("start"), F.collect_list("stop").alias("stop"))
    joined = own.join(lists, ["doc", "th"], "left").select("doc_id", "text", "start", "stop")

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sizes, spans, kept = [], [], []
            for text, start, stop in zip(pdf["text"], pdf["start"], pdf["stop"], strict=True):
                raw = text.encode("utf-8", "replace") if text else b""
                sizes.append(len(raw))
                if start is None:
                    spans.append([])
                    kept.append(raw)
                    continue
                c = np.bincount(start, minlength=len(raw) + 1) - np.bincount(stop, minlength=len(raw) + 1)
                gone = np.cumsum(c)[: len(raw)] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
                spans.append([{"start": int(a), "stop": int(b)} for a, b in edge])
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    return joined.mapInPandas(cut, f"doc_id {dict(own.dtypes)['doc_id']}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
