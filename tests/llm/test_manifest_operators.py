"""The Merkle manifest, the conversation trie and token counts against brute force."""

import random
import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.llm import conversation_trie, merkle_manifest, registry, token_counts


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# Merkle manifest


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*map(field, row))


def lifted(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        out.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return out


def brute_manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, lifted([leaf(r) for r in own])
    top = lifted([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        own, levels = trees[s]
        for at, r in enumerate(own):
            sides = path(levels, at) + path(top, k)
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                seen = (*r[:4], low(r[4]) if r[4] is not None else None)
            node = leaf(seen)
            for a, b in sides:
                node = h(*a, node, *b)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], h(*[x for a, b in sides for x in (*a, *b)]), node, node == top[-1][0]))
    return sorted(out, key=str)


def op11(df, tmp_path, spark):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in merkle_manifest.op11(spark, str(tmp_path)).collect()), key=str)


DOC = "doc_id long, source string, lang string, n_chars long, text string, tree string, block string, at string, n string, seen string, leaf string"


@pytest.mark.parametrize("kind", ["odd", "long", "many sources"])
def test_manifest(spark, tmp_path, kind):
    rnd = random.Random(kind)
    some = lambda: rnd.choice([None, "", "Aé b", "ÀB", "x" * 50])
    if kind == "odd":  # nulls, ties, repeated rows, a lone leaf, a very long text
        rows = [(rnd.choice([None, 5, 7, k]), rnd.choice([None, "s", "é", "Z"]), some(), rnd.choice([None, k]), some()) for k in range(120)]
        rows += [(1, "s", None, 1, "Aa")] * 20 + [(2, "lone", "en", 3, "B" * 300_000), (3, "", "en", 3, "c")]
    elif kind == "long":  # several blocks, the last of one leaf
        rows = [(k, "hot" if k < 4096 * 2 + 1 else f"s{k % 3}", None, k, f"T{k}") for k in range(9000)]
    else:
        rows = [(k, f"s{k % 300}", None, k, "T") for k in range(700)]
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], DOC).repartition(5)
    assert op11(df, tmp_path, spark) == brute_manifest(rows)


def test_manifest_empty(spark, tmp_path):
    assert op11(spark.createDataFrame([], DOC), tmp_path, spark) == []


def test_growing_holds_little():
    nodes = merkle_manifest.Growing(2)
    for k in range(256):
        nodes.add(f"{k:064d}".encode() * 16)
        assert sum(map(len, nodes.parts)) <= 2 * merkle_manifest.RUN
    assert len(nodes.nodes()) == merkle_manifest.RUN


# Conversation trie


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    item = lambda t: h(f"{len(t[1].encode())}:{t[1]}{t[2]}")
    for c, ts in own.items():
        own[c] = [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, item(t)))]
    built = {}
    for c, ts in own.items():
        n = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:n] + ts[n:])
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, cs in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(cs) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), kids.get(p, 0), leaves[p], saved[p], h(ends)))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, k string, depth string, size string, item string, block string, rank string"


def op12(spark, rows, tmp_path):
    spark.createDataFrame([(*r, *["x"] * 6) for r in rows], TURNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in conversation_trie.op12(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("kind", ["odd", "copies", "long"])
def test_trie(spark, tmp_path, kind):
    rnd = random.Random(kind)
    if kind == "odd":  # nulls everywhere, ties, repeated rows, absent bases, negative ids
        rows = [(rnd.choice([None, *range(-12, 30)]), rnd.choice([None, 1, 2, 3, 9]), rnd.choice([None, "", "user"]), rnd.choice([None, "", "a", "é", "aé"])) for _ in range(400)]
        rows += [(7, 3, "user", "a")] * 3 + [(10**12 + 3, 0, "u", "w " * 100_000)]
    elif kind == "copies":  # few different turns, so that many conversations share and end at the same nodes
        rows = [(c, t, "u", rnd.choice(["x", "yé"] if t > 5 else ["same"])) for c in range(600) for t in range(rnd.choice([0, 3, 8, 11]))]
    else:  # several levels of blocks; forks far down
        rows = [(c, t, "u", f"t{t}" if t < fork else f"{c}:{t}") for c, n, fork in [(0, 700, 700), (5, 700, 300), (10, 257, 256), (15, 256, 255), (20, 16, 16), (25, 17, 17), (31, 40, 20)] for t in range(n)]
    got = op12(spark, rows, tmp_path)
    assert got == brute_trie(rows)


def test_trie_empty(spark, tmp_path):
    assert op12(spark, [], tmp_path) == []


def test_long_conversations_stay_linear(spark):
    """One conversation of n turns makes about 17 rows for each turn, not n."""
    items = spark.range(3000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("depth"), F.col("id").cast("string").cast("binary").alias("item"), F.lit(1).cast("long").alias("size"))
    chain = conversation_trie.chains(items)
    assert chain.agg(F.max(F.size("digests"))).first()[0] == 16
    got = conversation_trie.prefix_trie(items).agg(F.count("*"), F.max("depth"), F.max("n_leaves"), F.sum("n_children")).first()
    assert tuple(got) == (3000, 2999, 1, 2999)


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_conversation_trie"])
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = registry.QUERIES[name](spark, sf_dir)
    want = con.execute(registry.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.fetchall(), key=str)


# Token counts


@pytest.fixture(scope="module")
def library():
    from pathlib import Path

    return token_counts.load(Path(token_counts.default_tokenizer()).read_text())


SIGNS = ["a", "b", "the", " the", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "'s", "'", "1", "½", "²", "_", ".", "!?", "\xa0", "\x1c", "\x85", "漢字", "🙂", "​", "　", "᠎", "İ", "ﬁ", "́", "٣", "<|endoftext|>", "ing ", "﻿"]


def test_token_counts(spark, make_docs, library):
    rnd = random.Random(1)
    texts = [None, "", " ", "\n", "word " * 60_000, "x" * 200_000, "\n" * 5000, " " * 5000, "<|endoftext|>"]
    texts += ["".join(rnd.choice(SIGNS) for _ in range(rnd.randrange(14))) for _ in range(4000)]
    rows = [(rnd.choice([None, k, 3]), t) for k, t in enumerate(texts)]
    got = token_counts.token_counts(make_docs(rows)).collect()
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for d, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(make_docs([])).count() == 0


def test_whole_table(spark, sf_dir, documents, library):
    got = {r.doc_id: r.n_tokens for r in token_counts.op13(spark, sf_dir).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in documents.select("doc_id", "text").collect()}


def test_whole_tokens_are_proved(library):
    from pathlib import Path

    whole = token_counts.whole_tokens(Path(token_counts.default_tokenizer()).read_text())
    assert len(whole) > 49_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole, add_special_tokens=False))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_kinds(make_docs, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    rows = [(1, "The Quick brown\n fox  "), (2, None), (3, "été 漢字 " * 50)]
    if name.endswith(".model"):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        want = {d: len(own.encode(t or "")) for d, t in rows}
    else:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        want = {d: len(own.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    got = token_counts.token_counts(make_docs(rows), path, limit=20).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert {r.doc_id for r in got if r.over_limit} == {d for d, n in want.items() if n > 20}
