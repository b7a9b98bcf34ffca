"""Token counts of whole texts, with a shortcut for words that are one token.

The driver proves once which strings of the vocabulary stand alone as one
pre-token and are encoded as one token; that list is as long as the vocabulary at most, and goes out
with the tokenizer's own file. Tasks cut texts into pre-tokens, count those on the list as one
without merging, merge each other distinct pre-token once and remember its count for a while.
Documents are not shuffled, and ids are never made.

Byte-level tokenizers (of the ``tokenizers`` library, splitting by their own
pattern and not normalising) go this way. Texts that hold an added token's string, and all
texts where the tokenizer is of another kind (sentencepiece files too), are encoded whole by the library.

Defined results: null text is empty (0 bytes, 0 tokens); null and repeated doc_ids keep their
rows; an empty table gives an empty result; texts may be of any length; other
columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task cuts at a time, and pieces and words that it remembers before it starts anew.
BLOCK_BYTES = 4 << 20
REMEMBERED = 400_000
#: A space in front of a non-space always begins a pre-token.
_CUT = re.compile(r" (?=\S)")
#: Below this character, letters, digits and white space are the same in all versions of Unicode, but for the controls.
_PLAIN_END = "ɐ"
_CONTROLS = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\xa0]")
#: How byte-level tokenizers split a text (fixed value).
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: itself where it is printable, else the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


def load(rule: str):
    """A tokenizer from the text of its file, without truncation or padding."""
    from tokenizers import Tokenizer

    out = Tokenizer.from_str(rule)
    out.no_truncation()
    out.no_padding()
    return out


def splits_bytes(rule: str) -> bool:
    """Whether the tokenizer splits by the fixed pattern and merges bytes, so that pre-tokens can be counted apart."""
    rule = json.loads(rule)
    kind = rule["pre_tokenizer"] or {}
    model = rule["model"]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    return rule["normalizer"] is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space") and model["type"] == "BPE" and plain


def whole_tokens(rule: str) -> list[str]:
    """The strings of the vocabulary, as texts, that are one pre-token when alone and that the model encodes as one token."""
    own = load(rule)
    byte_of = {c: b for b, c in byte_letters().items()}
    out = []
    for entry in own.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte_of[c] for c in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if [p for p, _ in own.pre_tokenizer.pre_tokenize_str(text)] == [entry] and len(own.model.tokenize(entry)) == 1:
            out.append(text)
    return sorted(out)


class WordCounter:
    """Token counts of texts by their pre-tokens."""

    def __init__(self, rule: str, whole: Iterable[str]):
        import regex

        self.tokenizer = load(rule)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = dict.fromkeys(whole, 1)
        self.letters = byte_letters()
        self.split = regex.compile(_WORDS).findall
        self.merged: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def _merge(self, word: str) -> int:
        """Tokens of a pre-token, as the vocabulary writes it."""
        return len(self.tokenizer.model.tokenize(word))

    def _word(self, word: str) -> int:
        n = self.whole.get(word) or self.merged.get(word)
        if n is None:
            n = self.merged[word] = self._merge(word.encode().decode("latin-1").translate(self.letters))
        return n

    def piece(self, piece: str) -> int:
        """Tokens of a text that begins and ends between pre-tokens."""
        n = self.whole.get(piece) or self.pieces.get(piece)
        if n is None:
            if not piece:
                return 0
            if max(piece) < _PLAIN_END and not _CONTROLS.search(piece):
                n = sum(map(self._word, self.split(piece)))
            else:
                n = sum(self._merge(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece))
            self.pieces[piece] = n
        return n

    def _apart(self, text: str) -> int:
        if any(a in text for a in self.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *rest = _CUT.split(text)
        return self.piece(first) + sum(self.piece(" " + p) for p in rest)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an array of strings without nulls."""
        if len(self.pieces) + len(self.merged) > REMEMBERED:
            self.pieces, self.merged = {}, {}
        split = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(split.flatten())
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        first = ends - sizes
        # All words but the first stand after a space, which belongs to them unless white space or another space follows.
        odd = np.fromiter((not w or w[0].isspace() for w in words), bool, len(words))
        at_odd = odd[codes]
        at_odd[first] = False
        apart = np.zeros(len(texts), bool)
        apart[np.searchsorted(ends, np.flatnonzero(at_odd), "right")] = True
        for a in self.added:
            apart |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        used = np.zeros(len(words), bool)
        mine = np.repeat(~apart, sizes)
        mine[first] = False
        used[codes[mine]] = True
        counts = np.fromiter((self.piece(" " + w) if u else 0 for w, u in zip(words, used.tolist(), strict=True)), np.int64, len(words))
        each = np.where(mine, counts[codes], 0)
        each[first] = [0 if a else self.piece(words[c]) for a, c in zip(apart.tolist(), codes[first].tolist(), strict=True)]
        out = np.add.reduceat(each, first) if len(each) else np.zeros(0, np.int64)
        for k in np.flatnonzero(apart).tolist():
            out[k] = self._apart(texts[k].as_py())
        return out


def _whole_texts(path: str, raw: bytes) -> Callable[[pa.Array], np.ndarray]:
    """Counts of a tokenizer of another kind."""
    if path.endswith(".model"):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=raw)
        return lambda texts: np.array([len(own.encode(t, num_threads=1)) for t in texts.to_pylist()], np.int64)
    own = load(raw.decode())
    return lambda texts: np.array([len(e.ids) for e in own.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)], np.int64)


def _kept(path: str, raw: bytes, whole: list[str] | None) -> Callable[[pa.Array], np.ndarray]:
    """One counter for each Python worker, so that what it has learnt serves the worker's next tasks."""
    kept = sys.modules.setdefault("_quire_counters", types.ModuleType("_quire_counters")).__dict__
    key = f"{path} {hash(raw)}"
    if key not in kept:
        kept[key] = _whole_texts(path, raw) if whole is None else WordCounter(raw.decode(), whole)
    return kept[key]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in order, about BLOCK_BYTES of text at a time."""
    size = np.cumsum(batch.column("n_bytes").to_numpy())
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row. ``tokenizer`` is a .json or .model file that the driver can read."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    raw = Path(path).read_bytes()
    fast = path.endswith(".json") and splits_bytes(raw.decode())
    # A vocabulary's size bounds what goes out.
    sent = spark.sparkContext.broadcast((path, raw, whole_tokens(raw.decode()) if fast else None))
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = _kept(*sent.value)
        for batch in it:
            for some in _blocks(batch):
                n = pa.array(counter(some.column("text")), pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])

    sized = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
