"""Benchmark decontamination with suffix arrays of the training text.

The documents of a task are cut into shards of bounded size. A shard's words
become numbers (words that no benchmark item has are breaks, as no match can
hold them), its suffixes are sorted, and every suffix of every benchmark item
is binary-searched in the sorted order: the range of equal prefixes gives the
places of a window of 13 words. Windows that follow each other in item and document alike
make up one verbatim match, as long as it goes; the words that matches cover are hit.
``longest_matches`` gives, for every benchmark suffix, its longest match in the whole corpus.

The documents are not shuffled and read once. The benchmark reaches the executors in blocks
of at most ``block_words`` words (one item, if it is longer); a worker goes through its shard
once for each block and holds one block at a time, and the result does not depend on them.

Defined results: null text has no words; an item without words has no window;
an item of fewer than 13 words is one window; matches never cross documents;
each row is judged by its own text and gives one row; a null item_id is
reported as the empty string, and items that share an id count as one; other columns of
the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 2_000_000


def _table() -> bytes:
    out = bytearray(b" " * 256)
    for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        out[c] = c
    for c in range(0x41, 0x5B):
        out[c] = c + 32
    return bytes(out)


_WORDS = _table()


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and characters beyond ASCII, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_WORDS).split() if text else []


class Benchmark:
    """Items as numbered words in one array, a 0 after each, and their windows as places in it."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.vocab: dict[bytes, int] = {}
        self.ids: list[str] = []
        seqs = []
        for item, text in items:
            seqs.append(np.array([*(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)), 0], np.int32))
            self.ids.append("" if item is None else str(item))
        self.flat = np.concatenate([np.zeros(0, np.int32), *seqs])
        self.sizes = np.array([len(x) - 1 for x in seqs], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.sizes + 1)])

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place, length) of every window."""
        n = np.where(self.sizes > 0, np.maximum(self.sizes - WINDOW + 1, 1), 0)
        item = np.repeat(np.arange(len(n)), n)
        return item, np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n) + self.offset[item], np.minimum(self.sizes, WINDOW)[item]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place, length) of every suffix."""
        item = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.flatnonzero(self.flat)
        return item, place, self.offset[item] + self.sizes[item] - place

    @classmethod
    def of(cls, state: dict) -> Benchmark:
        """From the ``__dict__`` of another; broadcasts hold plain data only."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out


def _opened(sent: list) -> Iterator[Benchmark]:
    """The blocks one after the other; of several, only one stays in the worker's memory."""
    for b in sent:
        yield Benchmark.of(b.value)
        if len(sent) > 1:
            b.__dict__.pop("_value", None)


def suffix_array(seq: np.ndarray, top: int, depth: int) -> np.ndarray:
    """Starts of the suffixes that begin with a word, sorted by their first ``depth`` words.

    ``seq``: word numbers from 1 to ``top``, 0 for breaks. Words are packed into one
    key; what is still tied is sorted by doubling.
    """
    n = len(seq)
    start = np.flatnonzero(seq)
    if not len(start):
        return start
    bits = max(1, int(top).bit_length())
    span = max(1, min(depth, 62 // bits))
    padded = np.concatenate([seq.astype(np.int64), np.zeros(span, np.int64)])
    key = np.zeros(len(start), np.int64)
    for j in range(span):
        key = key << bits | padded[start + j]
    order = np.argsort(key, kind="stable")
    sa, key = start[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    while span < depth:
        group = np.cumsum(new)
        tied = ~new | np.concatenate([~new[1:], [False]])
        if not tied.any():
            break
        rank = np.zeros(n + span, np.int64)
        rank[sa] = group
        at = np.flatnonzero(tied)
        second = rank[sa[at] + span]
        order = np.lexsort((second, group[at]))
        sa[at], second, own = sa[at][order], second[order], group[at]
        new[at] = np.concatenate([[True], (own[1:] != own[:-1]) | (second[1:] != second[:-1])])
        span *= 2
    return sa


def _compare(text: np.ndarray, at: np.ndarray, flat: np.ndarray, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign of (suffix of ``text`` at ``at``) minus (``length`` words of ``flat`` at ``place``), and how many words agree.

    Both arrays end with a 0, which no word equals.
    """
    same, sign, width = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), WINDOW
    open_ = np.flatnonzero(length > 0)
    while len(open_):
        k = same[open_][:, None] + np.arange(width)
        diff = text[np.minimum(at[open_][:, None] + k, len(text) - 1)] - flat[np.minimum(place[open_][:, None] + k, len(flat) - 1)]
        diff[k >= length[open_][:, None]] = 0
        odd = diff != 0
        first = np.where(odd.any(1), odd.argmax(1), width)
        same[open_] = np.minimum(same[open_] + first, length[open_])
        found = first < width
        sign[open_[found]] = np.sign(diff[found, first[found]])
        open_ = open_[~found & (same[open_] < length[open_])]
        width = min(4096, 2 * width)
    return sign, same


def search(text: np.ndarray, sa: np.ndarray, flat: np.ndarray, place: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
    """For each of some stretches of ``flat``, how many suffixes sort before it (``after``: before it or with it as a prefix)."""
    lo, hi = np.zeros(len(place), np.int64), np.full(len(place), len(sa), np.int64)
    while (open_ := lo < hi).any():
        at = np.flatnonzero(open_)
        mid = (lo[at] + hi[at]) // 2
        sign, _ = _compare(text, sa[mid], flat, place[at], length[at])
        right = sign <= 0 if after else sign < 0
        lo[at[right]] = mid[right] + 1
        hi[at[~right]] = mid[~right]
    return lo


class Shard:
    """Suffix array over some documents, sorted by the first ``depth`` words."""

    def __init__(self, bench: Benchmark, docs: list[list[bytes]], depth: int = WINDOW):
        get = bench.vocab.get
        self.sizes = np.array([len(d) for d in docs], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.seq = np.zeros(int(self.offset[-1]) + 1, np.int32)
        for d, at in zip(docs, self.offset, strict=False):
            self.seq[at : at + len(d)] = np.fromiter(map(get, d, repeat(0)), np.int32, len(d))
        self.sa = suffix_array(self.seq, len(bench.vocab), depth)

    def matches(self, bench: Benchmark) -> tuple[np.ndarray, ...]:
        """(document, start in it, item, start in it, words) of every verbatim match that holds a window, as long as it goes."""
        item, place, length = bench.windows()
        lo = search(self.seq, self.sa, bench.flat, place, length, False)
        n = search(self.seq, self.sa, bench.flat, place, length, True) - lo
        window = np.repeat(np.arange(len(n)), n)
        at = self.sa[np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        # Windows one step on in both texts go on with the match.
        shift = at - place[window]
        order = np.lexsort((at, shift, item[window]))
        window, at, shift = window[order], at[order], shift[order]
        new = np.concatenate([[True], (item[window[1:]] != item[window[:-1]]) | (shift[1:] != shift[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
        doc = np.searchsorted(self.offset, at[first], "right") - 1
        own = item[window[first]]
        return doc, at[first] - self.offset[doc], own, place[window[first]] - bench.offset[own], at[last] - at[first] + length[window[last]]

    def longest(self, bench: Benchmark, min_words: int, order: np.ndarray) -> tuple[np.ndarray, ...]:
        """(item, start in it, words, document, start in it) of each benchmark suffix's longest match; of its places the first by ``order`` of the documents."""
        item, place, length = bench.suffixes()
        if not len(self.sa):
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        at = search(self.seq, self.sa, bench.flat, place, length, False)
        best = np.zeros(len(place), np.int64)
        for near in (at, at - 1):
            _, same = _compare(self.seq, self.sa[np.clip(near, 0, len(self.sa) - 1)], bench.flat, place, length)
            best = np.maximum(best, same)
        keep = np.flatnonzero(best >= max(1, min_words))
        lo = search(self.seq, self.sa, bench.flat, place[keep], best[keep], False)
        hi = search(self.seq, self.sa, bench.flat, place[keep], best[keep], True)
        doc = np.searchsorted(self.offset, self.sa, "right") - 1
        by_place = np.lexsort((self.sa, order[doc]))
        rank = np.empty(len(self.sa) + 1, np.int64)
        rank[by_place], rank[-1] = np.arange(len(self.sa)), len(self.sa)
        ranges, of = np.unique(np.stack([lo, hi], 1).reshape(-1, 2), axis=0, return_inverse=True)
        least = np.minimum.reduceat(rank, ranges.ravel())[::2] if len(ranges) else lo
        found = by_place[least[of.ravel()]]
        return item[keep], place[keep] - bench.offset[item[keep]], best[keep], doc[found], self.sa[found] - self.offset[doc[found]]


def _shards(it: Iterator[pd.DataFrame], text: str) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    for pdf in it:
        toks, n, first = [], 0, 0
        for k, t in enumerate(pdf[text]):
            toks.append(words(t))
            n += len(toks[-1])
            if n >= SHARD_WORDS:
                yield pdf.iloc[first : k + 1], toks
                toks, n, first = [], 0, k + 1
        if toks:
            yield pdf.iloc[first:], toks


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[Benchmark]:
    """The items in blocks of bounded size; one block is on the driver at a time."""
    rows, n = [], 0
    for item, t in benchmark.select(item_id, text).toLocalIterator():
        k = len(words(t))
        if rows and n + k > block_words:
            yield Benchmark(rows)
            rows, n = [], 0
        rows.append((item, t))
        n += k
    yield Benchmark(rows)


def shard_hits(benches: Iterable[Benchmark], docs: list[list[bytes]], places: bool) -> tuple[np.ndarray, np.ndarray, list[list[str]], list[list[dict]]]:
    """Of each document its words, those inside a match, the items that match, and with ``places`` all matches."""
    sizes = np.array([len(d) for d in docs], np.int64)
    ends = np.cumsum(sizes)
    begins, cover = ends - sizes, np.zeros(int(ends[-1]) + 1, np.int64)
    items: list[set[str]] = [set() for _ in docs]
    listed: list[list[dict]] = [[] for _ in docs]
    for bench in benches:
        doc, at, item, start, n = Shard(bench, docs).matches(bench)
        cover += np.bincount(begins[doc] + at, minlength=len(cover)) - np.bincount(begins[doc] + at + n, minlength=len(cover))
        pair = np.unique(doc * len(bench.ids) + item) if len(doc) else doc
        for d, i in zip((pair // max(1, len(bench.ids))).tolist(), (pair % max(1, len(bench.ids))).tolist(), strict=True):
            items[d].add(bench.ids[i])
        if places:
            for d, p, i, q, k in zip(*(x.tolist() for x in (doc, at, item, start, n)), strict=True):
                listed[d].append({"item": bench.ids[i], "item_start": q, "start": p, "n": k})
    upto = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return sizes, upto[ends] - upto[begins], [sorted(x) for x in items], [sorted(x, key=lambda m: (m["start"], m["item"], m["item_start"])) for x in listed]


MATCH = "struct<item: string, item_start: long, start: long, n: long>"


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS, places: bool = True) -> DataFrame:
    """Columns doc_id, n_words, n_hit, n_items, items (sorted as strings), matches (item, item_start, start, n: in words), contaminated.

    Matches of a shard are arrays of numbers; only with ``places`` are they listed for each document.
    """
    sc = docs.sparkSession.sparkContext
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sent = [sc.broadcast(b.__dict__) for b in _blocks(benchmark, item_id, item_text, block_words)]

    def judge(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, toks in _shards(it, "text"):
            sizes, hits, items, listed = shard_hits(_opened(sent), toks, places)
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": sizes, "n_hit": hits, "items": items})
            yield out.assign(matches=listed) if places else out

    more = f", matches array<{MATCH}>" if places else ""
    out = own.mapInPandas(judge, f"doc_id {dict(own.dtypes)['doc_id']}, n_words long, n_hit long, items array<string>{more}")
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", *(["matches"] if places else []),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", min_words: int = 5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The longest verbatim match of each benchmark suffix in the corpus, with one place.

    Columns item_id (string), item_start, length, doc_id, doc_start, all in words; of
    equal lengths the smallest (doc_id, doc_start) stays, null doc_ids last. Matches are as long as they go;
    suffixes whose longest match is under ``min_words`` are left out.
    """
    sc = docs.sparkSession.sparkContext
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sent = [sc.broadcast(b.__dict__) for b in _blocks(benchmark, item_id, item_text, block_words)]

    def find(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, toks in _shards(it, "text"):
            order = pdf["doc_id"].rank(method="dense", na_option="bottom").to_numpy()
            ids = pdf["doc_id"].reset_index(drop=True)
            for bench in _opened(sent):
                depth = int(bench.sizes.max(initial=1))
                item, start, n, doc, at = Shard(bench, toks, depth).longest(bench, min_words, order)
                yield pd.DataFrame({"item_id": [bench.ids[i] for i in item], "item_start": start, "length": n, "doc_id": ids.iloc[doc].to_numpy(), "doc_start": at})

    out = own.mapInPandas(find, f"item_id string, item_start long, length long, doc_id {dict(own.dtypes)['doc_id']}, doc_start long")
    best = F.min_by(F.struct("doc_id", "doc_start", "length"), F.struct(-F.col("length"), F.col("doc_id").isNull(), "doc_id", "doc_start"))
    return out.groupBy("item_id", "item_start").agg(best.alias("b")).select("item_id", "item_start", "b.length", "b.doc_id", "b.doc_start")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), places=False)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT item_id, least(len(w), 13) AS k, unnest(list_transform(range(1, greatest(len(w) - 13, 0) + 2), lambda j: array_to_string(w[j : j + least(len(w), 13) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0
), ks AS (
  SELECT DISTINCT k FROM win
), pos AS (
  SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k
), occ AS (
  SELECT DISTINCT pos.doc_id, pos.p, pos.k, win.item_id
  FROM pos JOIN win ON win.k = pos.k AND win.s = array_to_string(pos.w[pos.p : pos.p + pos.k - 1], ' ')
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM occ) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM occ) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
