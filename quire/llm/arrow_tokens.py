"""Token ids as Arrow files of equal-length sequences with masks.

Documents are dealt by ranges of doc_id. Each task encodes its range, joins the
ids of all its documents and writes one Arrow IPC file whose record batches hold
``ids`` (fixed-size list of uint16 or uint32) and ``mask`` (fixed-size list of
bool; false only for the padding that ends a file), and one Arrow file with
doc_id, start and n_tokens of its documents. Any sequence can be read from a
mapped file without copying. Files are written under a temporary name and then
renamed, and a repeated task writes the same file again, so lost executors do no
harm.

Defined results: null text is empty (its only id is the end id); null doc_ids come
first; rows that share a doc_id follow each other by a hash of their text; an empty table
gives no files and an empty result; other columns are not read. Special-token
strings in a text follow the tokenizer's default unless ``ordinary_specials``.
"""

from __future__ import annotations

import json
import math
import os
import re
import string
import sys
import types
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import materialise, release, scratch_path

SEQUENCE = 2048
BATCH_SEQUENCES = 256
#: Bytes of text that are cut into words at a time, and that one file is made of at most on average.
BLOCK_BYTES = 6 << 20
FILE_BYTES = 256 << 20
#: Pieces whose ids a Python worker remembers; as many older ones are kept besides.
CACHE_WORDS = 300_000
_CUT = re.compile(r" (?=\S)")
SIGNS = string.punctuation


def _byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: itself where it is printable, else the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class Pieces:
    """Ids of pieces of text, one after the other in one array."""

    def __init__(self, dtype: np.dtype):
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype)
        self.start = np.zeros(1 << 16, np.int64)

    def add(self, pieces: list[str], ids: list[int], sizes: list[int]) -> None:
        """New pieces, with all their ids and the number of each one's."""
        k, to = len(self.slot), len(self.slot) + len(pieces)
        self.slot.update(zip(pieces, range(k, to), strict=True))
        while to + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.start[k + 1 : to + 1] = self.start[k] + np.cumsum(sizes)
        while self.start[to] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.start[k] : self.start[to]] = ids


def _gather(start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the lists ``at``, where list k is from ``start[k]`` to ``start[k + 1]``; and the members before each."""
    n = start[at + 1] - start[at]
    upto = np.concatenate([[0], np.cumsum(n)])
    kind = np.int32 if max(upto[-1], start[-1]) < 1 << 31 else np.int64
    return np.arange(upto[-1], dtype=kind) + np.repeat((start[at] - upto[:-1]).astype(kind), n), upto


class Encoder:
    """Ids of whole texts, the same as encoding them at once.

    Byte-level BPE splits words before it merges, and a space in front of a
    non-space always begins a new word; so a text can be cut there and each
    piece encoded once. Texts with added tokens, and all texts where the tokenizer is of
    another kind, are encoded whole.
    """

    def __init__(self, path: str, ordinary_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rule = json.loads(self.tokenizer.to_str())
        kind = rule["pre_tokenizer"] or {}
        self.cuts = rule["normalizer"] is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        self.letters = _byte_letters()
        self.now, self.old = Pieces(self.dtype), Pieces(self.dtype)

    def _parts(self, piece: str) -> list[str]:
        """Smaller pieces that the piece is made of, cut at single newlines between words and where a letter meets the signs at the end; itself if there are none."""
        if "\n" in piece:
            lines = piece.split("\n")
            if not any(a in piece for a in self.added) and all(x and not x[-1].isspace() and (not k or not x[0].isspace()) for k, x in enumerate(lines)):
                out = []
                for k, line in enumerate(lines):
                    out += ["\n", *self._parts(line)] if k else self._parts(line)
                return out
        else:
            word = piece.rstrip(SIGNS)
            if word[-1:].isalpha() and len(word) < len(piece) and not any(a in piece for a in self.added):
                return [word, piece[len(word) :]]
        return [piece]

    def _word(self, piece: str) -> str | None:
        """The piece as the vocabulary writes it, if it is one word of Latin letters with at most a space before; else None."""
        body = piece[1:] if piece[:1] == " " else piece
        if not body.isalpha():
            return None
        if not body.isascii():
            if max(body) >= "\u0250":
                return None
            body = body.encode().decode("latin-1").translate(self.letters)
        return self.letters[32] + body if piece[0] == " " else body

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of new pieces, from the older ones or from the tokenizer."""
        old, model, plain = self.old, self.tokenizer.model, []
        done, ids, sizes = [], [], []
        for p in pieces:
            if p in old.slot:
                k = old.slot[p]
                own = old.ids[old.start[k] : old.start[k + 1]].tolist()
            elif (word := self._word(p)) is not None:
                own = [t.id for t in model.tokenize(word)]
            else:
                plain.append(p)
                continue
            done.append(p)
            ids += own
            sizes.append(len(own))
        for at in range(0, len(plain), 20_000):
            some = plain[at : at + 20_000]
            for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                own = e.ids
                ids += own
                sizes.append(len(own))
        self.now.add(done + plain, ids, sizes)

    def _slots(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places, slots): the parts of piece k have the slots from ``places[k]`` to ``places[k + 1]``."""
        slot, parts, new = self.now.slot, [], {}
        sizes = np.ones(len(pieces), np.int64)
        for k, p in enumerate(pieces):
            if p in slot:
                parts.append(p)
                continue
            some = self._parts(p)
            parts += some
            sizes[k] = len(some)
            for x in some:
                if x not in slot:
                    new[x] = None
        if new:
            self._learn(list(new))
        return np.concatenate([[0], np.cumsum(sizes)]), np.fromiter(map(slot.__getitem__, parts), np.int64, len(parts))

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], self.dtype), np.array([len(ids) for ids in got], np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts (an array of strings without nulls), one after the other, and their number for each text."""
        if not self.cuts:
            return self._whole(texts.to_pylist())
        if len(self.now.slot) > CACHE_WORDS:
            self.old, self.now = self.now, Pieces(self.dtype)
        split = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(split.flatten())
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64))
        first = np.concatenate([[0], ends[:-1]])
        # All but the first word of a text stand after a space, which belongs to them unless white space follows.
        odd = np.fromiter((not w or w[0].isspace() for w in words), bool, len(words))[codes]
        odd[first] = False
        special = np.zeros(len(texts), bool)
        for a in self.added:
            special |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        apart = np.unique(np.concatenate([np.searchsorted(ends, np.flatnonzero(odd), "right"), np.flatnonzero(special)]))
        # Pieces: the words after a space, the first ones, and those of the texts that are cut another way.
        pieces = [" " + w for w in words]
        codes = codes.astype(np.int64)
        codes_of_first = len(pieces) + np.arange(len(texts))
        pieces += [words[c] for c in codes[first]]
        codes[first] = codes_of_first
        sizes = ends - first
        if len(apart):
            runs, last = [], 0
            for k in apart.tolist():
                text = texts[k].as_py()
                own = [text] if special[k] else [p if not j else " " + p for j, p in enumerate(_CUT.split(text))]
                runs += [codes[last : first[k]], len(pieces) + np.arange(len(own))]
                pieces += own
                last, sizes[k] = ends[k], len(own)
            codes = np.concatenate([*runs, codes[last:]])
            ends = np.cumsum(sizes)
        places, slots = self._slots(pieces)
        part, before = _gather(places, codes)
        place, upto = _gather(self.now.start, slots[part])
        upto = upto[before]
        return self.now.ids[place], upto[ends] - upto[ends - sizes]


def encoder(path: str, ordinary_specials: bool) -> Encoder:
    """One encoder for each Python worker, so that what it has learnt serves the worker's next tasks."""
    kept = sys.modules.setdefault("_quire_encoders", types.ModuleType("_quire_encoders")).__dict__
    key = f"{path} {ordinary_specials}"
    if key not in kept:
        kept[key] = Encoder(path, ordinary_specials)
    return kept[key]


def _store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a URI as Hadoop writes it."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI, by the file system that Spark takes it for; driver and executors then open the same place."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _open(uri: str):
    fs, path = _store(uri)
    return pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)


class SequenceWriter:
    """Cuts a stream of ids into equal sequences, written in batches."""

    def __init__(self, uri: str, length: int, dtype: np.dtype, end_id: int):
        self.fs, self.path = _store(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.temp = f"{self.path}.{os.urandom(6).hex()}"
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.length, self.dtype, self.end_id = length, dtype, end_id
        self.sink = self.fs.open_output_stream(self.temp)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.open, self.size = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.open.append(ids)
        self.size += len(ids)
        if self.size >= self.length * BATCH_SEQUENCES:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, self.dtype), *self.open])
        n = -(-len(ids) // self.length) if last else len(ids) // self.length
        use = min(len(ids), n * self.length)
        for at in range(0, n, BATCH_SEQUENCES):
            some = ids[at * self.length : min(use, (at + BATCH_SEQUENCES) * self.length)]
            rows = -(-len(some) // self.length)
            full = np.full(rows * self.length, self.end_id, self.dtype)
            full[: len(some)] = some
            mask = np.arange(rows * self.length) < len(some)
            cols = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (full, mask)]
            self.writer.write_batch(pa.record_batch(cols, schema=self.schema))
        self.open, self.size = [ids[use:].copy()], len(ids) - use

    def close(self) -> None:
        self._flush(True)
        self.writer.close()
        self.sink.close()
        self.fs.move(self.temp, self.path)


def _write_table(uri: str, table: pa.Table) -> None:
    fs, path = _store(uri)
    temp = f"{path}.{os.urandom(6).hex()}"
    with fs.open_output_stream(temp) as sink, pa.ipc.new_file(sink, table.schema) as w:
        w.write_table(table)
    fs.move(temp, path)


class SequenceFile:
    """Random access to the sequences of one file; nothing is copied from a mapped file."""

    def __init__(self, uri: str):
        self.reader = pa.ipc.open_file(_open(uri))
        kind = self.reader.schema.field("ids").type
        self.length = kind.list_size
        self.starts = [0]
        for b in range(self.reader.num_record_batches):
            self.starts.append(self.starts[-1] + self.reader.get_batch(b).num_rows)

    def __len__(self) -> int:
        return self.starts[-1]

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``k``."""
        b = int(np.searchsorted(self.starts, k, "right")) - 1
        batch, at = self.reader.get_batch(b), (k - self.starts[b]) * self.length
        ids, mask = (batch.column(c).values.slice(batch.column(c).offset * self.length + at, self.length) for c in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def stream(self) -> Iterator[np.ndarray]:
        """All real ids, one batch at a time."""
        for b in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(b)
            ids = batch.column(0).values.to_numpy()
            n = batch.column(1).values.true_count
            yield ids[:n]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in order, about BLOCK_BYTES of text at a time."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def write_tokens(docs: DataFrame, out: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, length: int = SEQUENCE, ordinary_specials: bool = False, parts: int | None = None) -> DataFrame:
    """Write the files under ``out``; returns the manifest: part, n_docs, n_tokens, in file order.

    The number of files follows the bytes of text, and is ``spark.sql.shuffle.partitions`` at least.
    """
    spark = docs.sparkSession
    out = qualified(spark, out)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((own.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / FILE_BYTES))
    # Rows that share a doc_id, null ones too, are dealt by their texts' hashes.
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    dealt = own.withColumn("h", F.xxhash64("text")).repartitionByRange(n, *order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, writer, docs, total = TaskContext.get().partitionId(), None, [], 0
        for block in _blocks(it):
            if writer is None:
                own = encoder(tokenizer, ordinary_specials)
                writer = SequenceWriter(f"{out}/part-{part:06d}.arrow", length, own.dtype, end_id)
            ids, sizes = own(block.column("text"))
            writer.add(np.insert(ids, np.cumsum(sizes), end_id))
            starts = total + np.concatenate([[0], np.cumsum(sizes + 1)])
            docs.append(pa.table({"doc_id": block.column("doc_id").cast(pa.int64()), "start": starts[:-1], "n_tokens": sizes + 1}))
            total = int(starts[-1])
        if writer is not None:
            writer.close()
            table = pa.concat_tables(docs)
            _write_table(f"{out}/part-{part:06d}.docs.arrow", table)
            yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [table.num_rows], "n_tokens": [total]})

    return materialise(dealt.mapInArrow(encode, "part long, n_docs long, n_tokens long"), "manifest")


def read_tokens(spark: SparkSession, out: str, manifest: DataFrame) -> DataFrame:
    """From the files: doc_id, start (over all files), n_tokens, ids_crc32 of the ids as little-endian uint32.

    The manifest has one row for each file; that is all the driver sees.
    """
    out, rows, before = qualified(spark, out), [], 0
    for r in sorted(manifest.collect()):
        rows.append((r.part, before))
        before += r.n_tokens
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(rows, "part long, before long").repartition(len(rows), "part")

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for part, before in zip(pdf["part"], pdf["before"], strict=True):
                docs = pa.ipc.open_file(_open(f"{out}/part-{part:06d}.docs.arrow")).read_all()
                ends = np.cumsum(docs["n_tokens"].to_numpy())
                crc, k, at = np.zeros(len(ends), np.int64), 0, 0
                for ids in SequenceFile(f"{out}/part-{part:06d}.arrow").stream():
                    raw, stop = ids.astype("<u4").data.cast("B"), at + len(ids)
                    while k < len(ends):
                        lo, hi = max(at, int(ends[k - 1]) if k else 0), min(stop, int(ends[k]))
                        crc[k] = zlib.crc32(raw[4 * (lo - at) : 4 * (hi - at)], int(crc[k]))
                        if ends[k] > stop:
                            break
                        k += 1
                    at = stop
                out_ = docs.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
                yield pd.DataFrame({"doc_id": out_["doc_id"], "start": before + docs["start"].to_numpy(), "n_tokens": docs["n_tokens"].to_numpy(), "ids_crc32": crc})

    return files.mapInPandas(read, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokens(docs: DataFrame, tokenizer: str | None = None, **options) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read them back."""
    spark = docs.sparkSession
    out = scratch_path(spark, "tokens")
    manifest = write_tokens(docs, out, tokenizer or default_tokenizer(), **options)
    release(spark)
    return read_tokens(spark, out, manifest)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
