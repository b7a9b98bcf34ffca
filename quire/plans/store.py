"""A stored bank that is kept up by batches: key-bucketed Parquet parts, a manifest for each state, a search index.

Every table lies under ``<table>/commit=<c>/bucket=<b>``. A batch writes only its own rows, in the buckets of their
keys, and the keys it touches: rows of earlier commits with such a key no longer count, so an
upsert replaces and a delete is a key without rows. A numbered manifest names the parts of a state with their
bytes and the corpus numbers of the index; it is created under a name that must not exist, so of two writers one
fails, and readers keep the state that they opened. ``compact`` merges the newest parts of a bucket while the next older one is not
much larger, so a row is rewritten about as often as the bank doubles; ``expire`` removes what the last manifests no longer name.

The index has a row for each word of each question, with its places and the question's length, in buckets by the hash of
the word. A query reads the buckets of its words only; a prefix reads all buckets, whose files are sorted by word.

The driver sees manifests and folder names: their number follows buckets and commits, not rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.operators import fts, merge
from quire.plans import bank as B

TOUCHED = "paper_code string, question bigint"
POSTINGS = "paper_code string, question bigint, term string, places array<int>, dl int"
STORED = {**B.SCHEMAS, "questions": B.SCHEMAS["questions"] + ", dl int", "touched": TOUCHED, "postings": POSTINGS}
#: Tables whose rows go when their question is touched.
KEYED = ("questions", *B.CHILDREN)
#: Lists of a manifest: those of the tables, the touched keys that count for tables, and those that count for the index.
LISTS = (*STORED, "retired")

#: Questions of a bucket, of a store that sets the number itself.
BUCKET_QUESTIONS = 20_000

Part = list  # [commit, bucket, bytes]


class BankStore:
    """``buckets`` and ``term_buckets`` hold for a new store, which takes them from its first batch's size if they are 0; one that is there keeps its own."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 0, term_buckets: int = 0):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self.root = B.folder(spark, self.path)
        self._new = {"number": -1, "buckets": buckets, "term_buckets": term_buckets, "top_paper": 0, "docs": 0, "words": 0, "parts": {t: [] for t in LISTS}}

    # Manifests

    def _at(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))

    def _names(self) -> list[str]:
        if not self.fs.exists(self.root):
            return []
        return sorted(n for f in self.fs.listStatus(self.root) if (n := f.getPath().getName()).startswith("current-"))

    def manifest(self) -> dict | None:
        """The newest state that has been written to its end; None where there is no bank."""
        for name in reversed(self._names()):
            try:
                return json.loads(self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()[0])
            except (TypeError, ValueError):  # its writer has not ended
                continue
        return None

    def _publish(self, state: dict, after: dict) -> dict:
        names = self._names()
        newest = self.manifest()
        if (newest["number"] if newest else -1) != after["number"]:
            raise B.BankChangedError(f"another writer has changed the bank at {self.path}")
        state["number"] = int(names[-1].rsplit("-", 1)[1]) + 1 if names else 0
        try:
            out = self.fs.create(self._at(f"current-{state['number']:012d}"), False)
        except Py4JJavaError as e:
            raise B.BankChangedError(f"another writer has changed the bank at {self.path}") from e
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        return state

    def _begin(self) -> tuple[dict, str]:
        """The state to go on from, and a commit that sorts after all of its own."""
        state = self.manifest() or json.loads(json.dumps(self._new))
        names = self._names()
        return state, f"{int(names[-1].rsplit('-', 1)[1]) + 1 if names else 0:012d}x{uuid.uuid4().hex[:12]}"

    # Parts

    def _bucket(self, name: str, state: dict) -> Column:
        if name == "postings":
            return F.pmod(F.xxhash64("term"), F.lit(state["term_buckets"])).cast("int")
        return F.pmod(F.xxhash64(*(["paper_code"] if name == "papers" else B.KEY)), F.lit(state["buckets"])).cast("int")

    def _write(self, name: str, rows: DataFrame, commit: str, state: dict) -> list[Part]:
        """Write a table's rows of a commit; Spark evens out large and small buckets."""
        # Buckets are hashes, so keys must have the stored types.
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(STORED[name]).fields])
        order = ["bucket", "term", *B.KEY] if name == "postings" else ["bucket", "paper_code"]
        dealt = rows.withColumn("bucket", self._bucket(name, state)).hint("rebalance", F.col("bucket")).sortWithinPartitions(*order)
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/{name}/commit={commit}")
        where = self._at(name, f"commit={commit}")
        folders = [f.getPath() for f in self.fs.listStatus(where) if f.getPath().getName().startswith("bucket=")]
        return sorted([commit, int(p.getName().split("=")[1]), self.fs.getContentSummary(p).getLength()] for p in folders)

    def _read(self, name: str, parts: Iterable[Part]) -> DataFrame:
        """Rows of some parts, with their commit and bucket."""
        folder = "touched" if name == "retired" else name
        ddl = f"{STORED[folder]}, commit string, bucket int"
        paths = [f"{self.path}/{folder}/commit={c}/bucket={b}" for c, b, _ in parts]
        if not paths:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("basePath", f"{self.path}/{folder}").parquet(*paths)

    def _live(self, name: str, parts: list[Part], touched: list[Part]) -> DataFrame:
        """Rows of the parts whose question no later commit touches, with commit and bucket."""
        rows = self._read(name, parts)
        first = min((p[0] for p in parts), default="")
        later = [p for p in touched if p[0] > first]
        if not later or name == "papers":
            return rows
        keys = self._read("touched", later).groupBy(*B.KEY).agg(F.max("commit").alias("_last"))
        mine = [rows[k] == keys[k] for k in B.KEY]
        return rows.join(keys, [*mine, keys["_last"] > rows["commit"]], "left_anti")

    def _table(self, state: dict, name: str, buckets: set[int] | None = None) -> DataFrame:
        own = [p for p in state["parts"][name] if buckets is None or p[1] in buckets]
        touched = [p for p in state["parts"]["touched"] if buckets is None or p[1] in buckets]
        return self._live(name, own, touched)

    # Reading

    def snapshot(self) -> B.Bank:
        """The newest state as a bank that searches by the stored index."""
        state = self.manifest()
        if state is None:
            raise B.BankMissingError(f"no bank at {self.path}")
        tables = {t: self._table(state, t).drop("commit", "bucket", "dl") for t in B.SCHEMAS}
        return B.Bank(self.spark, tables, Index(self, state))

    # Writing

    @staticmethod
    def _size(state: dict, questions: DataFrame) -> None:
        """Set the number of buckets of a new store that was not told any."""
        if not state["buckets"] or not state["term_buckets"]:
            n = questions.count() // BUCKET_QUESTIONS
            state["buckets"], state["term_buckets"] = state["buckets"] or min(4096, max(4, n)), state["term_buckets"] or min(4096, max(8, n))

    def _touch(self, state: dict, keys: DataFrame, commit: str) -> set[int]:
        """Write the keys that a commit touches; returns their buckets. Old lengths leave the corpus numbers."""
        parts = self._write("touched", keys, commit, state)
        buckets = {p[1] for p in parts}
        old = self._table(state, "questions", buckets).join(keys, B.KEY, "left_semi").agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        state["docs"], state["words"] = state["docs"] - old[0], state["words"] - old[1]
        # Where nothing is stored before, there is nothing to touch.
        known = {p[1] for p in state["parts"]["questions"]}
        state["parts"]["touched"] += [p for p in parts if p[1] in known]
        state["parts"]["retired"] += [p for p in parts if p[1] in known]
        return buckets

    def _add(self, state: dict, tables: dict[str, DataFrame], commit: str) -> None:
        """Write the rows of a commit, and their index."""
        questions = tables["questions"].withColumn("dl", F.size(fts.words(F.coalesce("text", F.lit("")))))
        self._size(state, questions)

        def write(name: str, rows: DataFrame) -> None:
            state["parts"][name] += self._write(name, rows, commit, state)

        # The tables do not wait for each other; the index reads the questions as they were written.
        with ThreadPoolExecutor(4) as pool:
            jobs = [pool.submit(write, name, rows) for name, rows in tables.items() if name != "questions"]
            write("questions", questions)
            written = self._read("questions", [p for p in state["parts"]["questions"] if p[0] == commit])
            write("postings", fts.postings(written, B.KEY).select("paper_code", "question", "term", "places", "dl"))
            for job in jobs:
                job.result()
        new = written.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0)), F.coalesce(F.max("paper_id"), F.lit(0))).first()
        state["docs"], state["words"], state["top_paper"] = state["docs"] + new[0], state["words"] + new[1], max(state["top_paper"], new[2])

    def upsert(self, built: DataFrame) -> dict:
        """Load a batch of classified questions, as ``Bank.upsert`` does; returns the new manifest."""
        state, commit = self._begin()
        before = dict(state)
        own = B.newest(built).persist()
        try:
            self._size(state, own)
            buckets = self._touch(state, own.select(*B.KEY), commit)
            codes = own.select("paper_code").distinct()
            homes = {r[0] for r in codes.select(self._bucket("papers", state)).distinct().collect()} if buckets else set()
            known = self._table(state, "papers", homes).select("paper_code", "paper_id")
            papers = merge.with_ids(known, codes, "paper_id", "paper_code", state["top_paper"]).join(codes, "paper_code", "left_semi").persist()
            tables = B.parts_of(self.spark, own, papers)
            tables["papers"] = papers.join(known, "paper_code", "left_anti").select("paper_code", "paper_id")
            self._add(state, tables, commit)
            papers.unpersist()
        finally:
            own.unpersist()
        return self._publish(state, before)

    def delete(self, keys: DataFrame) -> dict:
        """Drop the questions of (paper_code, question); keys that are not there do no harm."""
        state, commit = self._begin()
        before = dict(state)
        keys = keys.persist()
        self._size(state, keys)
        self._touch(state, keys.select(*B.KEY).where("paper_code is not null and question is not null").distinct(), commit)
        keys.unpersist()
        return self._publish(state, before)

    def replace(self, bank: B.Bank) -> dict:
        """A bank in place of all that is stored."""
        state, commit = self._begin()
        before = dict(state)
        state = {**state, "docs": 0, "words": 0, "parts": {t: [] for t in LISTS}}
        self._add(state, dict(bank.t), commit)
        top = bank.t["papers"].agg(F.coalesce(F.max("paper_id"), F.lit(0))).first()[0]
        state["top_paper"] = max(state["top_paper"], top)
        return self._publish(state, before)

    # Upkeep

    @staticmethod
    def _due(parts: list[Part], fanout: int) -> dict[int, list[Part]]:
        """By bucket, the newest parts that are worth merging: more than ``fanout``, with older ones as long as they are not twice as large as what is merged."""
        out = {}
        by_bucket: dict[int, list[Part]] = {}
        for p in sorted(parts, reverse=True):
            by_bucket.setdefault(p[1], []).append(p)
        for b, newest_first in by_bucket.items():
            if len(newest_first) > fanout:
                taken, size = [], 0
                for p in newest_first:
                    if len(taken) > 1 and p[2] > 2 * size:
                        break
                    taken.append(p)
                    size += p[2]
                out[b] = taken
        return out

    def compact(self, fanout: int = 4) -> dict:
        """Merge parts of buckets that have more than ``fanout``; the rows that count stay the same."""
        state, commit = self._begin()
        before = dict(state)
        parts = state["parts"]
        for name in (*B.SCHEMAS, "postings"):
            due = self._due(parts[name], fanout)
            if not due:
                continue
            gone = [p for some in due.values() for p in some]
            rows = self._live(name, gone, parts["retired" if name == "postings" else "touched"])
            kept = [p for p in parts[name] if p not in gone]
            parts[name] = kept + self._write(name, rows.select(*[c for c in rows.columns if c not in ("commit", "bucket")]), commit, state)
        # Touched keys count as long as a part is older than they are.
        oldest = lambda names, b: min((p[0] for n in names for p in parts[n] if b is None or p[1] == b), default="~")
        homes = {p[1]: oldest(KEYED, p[1]) for p in parts["touched"]}
        parts["touched"] = [p for p in parts["touched"] if homes[p[1]] < p[0]]
        words = oldest(["postings"], None)
        parts["retired"] = [p for p in parts["retired"] if words < p[0]]
        return self._publish(state, before)

    def expire(self, keep: int = 2) -> int:
        """Remove the manifests before the last ``keep`` and all parts that none of the others names; returns the folders removed.

        A batch that is being written by another writer is named by no manifest yet: run this when none is.
        """
        names = self._names()
        named: dict[str, set[tuple[str, int]]] = {t: set() for t in STORED}
        for n in names[-keep:]:
            state = json.loads(self.spark.read.text(f"{self.path}/{n}", wholetext=True).first()[0])
            for t, parts in state["parts"].items():
                named["touched" if t == "retired" else t] |= {(c, b) for c, b, _ in parts}
        for n in names[:-keep]:
            self.fs.delete(self._at(n), False)
        gone = 0
        for t, alive in named.items():
            for commit in self.fs.listStatus(self._at(t)) if self.fs.exists(self._at(t)) else []:
                c, left = commit.getPath().getName().split("=")[1], 0
                for bucket in self.fs.listStatus(commit.getPath()):
                    b = bucket.getPath().getName()
                    if b.startswith("bucket="):
                        dead = (c, int(b.split("=")[1])) not in alive
                        gone, left = gone + dead, left + (not dead)
                        if dead:
                            self.fs.delete(bucket.getPath(), True)
                if not left:
                    self.fs.delete(commit.getPath(), True)
        return gone


class Index:
    """The inverted index of one state."""

    def __init__(self, store: BankStore, state: dict):
        self.store, self.state = store, state
        self.docs, self.words = state["docs"], state["words"]

    def postings(self, terms: list[str] | None) -> DataFrame:
        """(paper_code, question, term, places, dl) from the buckets of some words; of all buckets without them."""
        parts = self.state["parts"]["postings"]
        if terms is not None:
            n = F.lit(self.state["term_buckets"])
            one = self.store.spark.sql("SELECT 1 AS one").select(F.array(*[F.pmod(F.xxhash64(F.lit(t)), n).cast("int") for t in terms] or [F.lit(-1)])).first()[0]
            parts = [p for p in parts if p[1] in set(one)]
        return self.store._live("postings", parts, self.state["parts"]["retired"]).drop("commit", "bucket")


