"""Fingerprints, neighbours, URLs, mixing, languages and token files."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import arrow_tokens, entropy_mix, graph, hnsw, lang_embed, simhash_ball, url_markov
from quire.llm.common import ascii_lower, global_rank

# SimHash


def brute_fingerprint(t, n=4):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints(documents, make_docs):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(10**6, None), (10**6 + 1, " \n"), (10**6 + 2, "One two"), (10**6 + 3, "oNE\ttwo"), (10**6 + 4, "é " * 30000)]
    rows.sort()
    out = simhash_ball.near_duplicates(make_docs(rows)).orderBy("doc_id").collect()
    fps = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    assert [r.fp & (2**64 - 1) for r in out] == fps.tolist()
    label = brute_components(fps)
    assert [r.component_id for r in out] == [rows[k][0] for k in label]
    assert simhash_ball.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("room", [1 << 21, 1 << 10])
def test_dense_fingerprints(spark, monkeypatch, room):
    rng = np.random.default_rng(0)
    made = []
    for b in rng.integers(0, 2**63, 30).tolist():
        x = int(b)
        for _ in range(40):
            y = x
            for k in rng.choice(64, int(rng.integers(0, 5)), replace=False).tolist():
                y ^= 1 << k
            made.append(y)
            x = y if rng.random() < 0.3 else x
    fps = np.unique(np.array(made, np.uint64))
    monkeypatch.setattr(simhash_ball, "GROUP_VARIANTS", room)
    df = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    root = {r.fp: r.root for r in simhash_ball.fingerprint_components(df).collect()}
    got = pd.Series([root.get(x, x) for x in fps.view(np.int64).tolist()])
    want = pd.Series(brute_components(fps))
    assert got.groupby(want).nunique().max() == 1 and want.groupby(got).nunique().max() == 1


def test_similar_documents(make_docs):
    rng = np.random.default_rng(4)
    vocab = ["".join(rng.choice(list("abcdefghij"), int(n))) for n in rng.integers(2, 8, 3000)]
    base = [[vocab[int(k)] for k in rng.zipf(1.3, 300) % 3000] for _ in range(60)]
    rows = [(k, " ".join(w)) for k, w in enumerate(base)]
    for k, w in enumerate(base):
        v = list(w)
        for at in rng.choice(300, k % 12, replace=False):
            v[int(at)] = f"edit{int(at)}"
        rows.append((100 + k, " ".join(v)))
    rows += [(500, rows[3][1]), (501, None), (502, ""), (503, "one"), (503, "one"), (None, rows[4][1]), (504, "é " * 30000)]
    out = simhash_ball.similar_documents(make_docs(rows)).collect()
    got = {r.doc_id: r.component_id for r in out}

    def alike(x, y):
        a, b = ({tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in (x, y))
        return len(a & b) / len(a | b)

    text = dict(rows)
    same = [alike(text[k], text[100 + k]) >= 0.8 for k in range(60)]
    linked = [got[100 + k] == k for k in range(60)]
    assert len(out) == len(rows) and not any(b and not a for a, b in zip(same, linked, strict=True))
    assert sum(a and b for a, b in zip(same, linked, strict=True)) >= 0.9 * sum(same)
    assert got[500] == 3 and got[501] == got[502] == 501 and got[503] == 503 and got[None] == 4 and got[504] == 504
    assert simhash_ball.similar_documents(make_docs([])).count() == 0


def test_near_families(make_docs):
    """Edits that are alike to their base only: each that meets it must be linked, whichever pairs are tried first."""
    rng, rows = np.random.default_rng(8), []
    for f in range(6):
        base = [f"w{int(k)}" for k in rng.integers(0, 10**6, 300)]
        for e in range(16):
            v = list(base)
            for k in range(5 if e < 15 else 0):
                v[10 + 57 * k + int(rng.integers(0, 50))] = f"edit{e}x{k}"
            rows.append((100 * f + e, " ".join(v)))
    got = {r.doc_id: r.component_id for r in simhash_ball.similar_documents(make_docs(rows, clash=False)).collect()}
    fps = {k: np.array(simhash_ball.several(t, 2, simhash_ball.SEEDS), np.int64) for k, t in rows}
    meets = {k for k in fps if np.bitwise_count(fps[k] ^ fps[k // 100 * 100 + 15]).min() <= 4}
    assert len(meets) >= 60 and all(got[k] == got[k // 100 * 100 + 15] for k in meets)


def test_forest():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 60, 80), rng.integers(0, 60, 80)
    kept = simhash_ball.forest(60, a, b)
    join = lambda edges: brute_components_of(60, a[edges], b[edges])
    assert join(kept) == join(np.arange(80)) and len(kept) == 60 - len(set(join(kept)))


def brute_components_of(n, a, b):
    label = list(range(n))
    for _ in range(n):
        for x, y in zip(a, b, strict=True):
            label[x] = label[y] = min(label[x], label[y])
    return label


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40) if k % 10] + [(100, 105), (105, 100), (7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[40] == 31 and got[20] == 11 and got[9] == 1 and got[105] == 100
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    few = graph.components(spark.createDataFrame(edges, "a long, b long"), few=10**6)
    assert {r.node: r.root for r in few.collect()} == got
    assert graph.components(spark.createDataFrame([], "a long, b long"), few=10).count() == 0


# Neighbours


def test_neighbours(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    rng = np.random.default_rng(2)
    x = np.concatenate([np.stack(e.embedding.to_numpy()).astype(float), rng.normal(size=(900, 64)) * rng.uniform(0.5, 2, (900, 1))])
    x[200:230] = 4 * x[200]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    bad = [(5000, None), (5020, []), (5040, [0.0] * 64), (5060, [1.0, None]), (5080, [float("nan")] * 64), (None, rows[0][1]), (5100, [float("inf")] * 64), (6000, [1.0, 2.0]), (6001, [2.0, 1.0])]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>").withColumn("shard", F.lit("x")).withColumn("score", F.lit(1))
    vectors = hnsw.clean(df)
    index = hnsw.build_index(vectors, shard_rows=400)
    assert index.agg(F.count("*")).first()[0] > 2
    got = hnsw.search(index, vectors.where("vec_id % 20 = 0"), 20).toPandas()
    found = 0
    for q, part in got.groupby("query_id"):
        if q >= 5000:
            assert part.vec_id.tolist() == [6001]
            continue
        part = part.sort_values("rank")
        s = x @ x[q]
        s[q] = -np.inf
        best = sorted(range(len(x)), key=lambda k: (-s[k], k))[:20]
        found += sum(-v >= -s[best[-1]] - 1e-9 or v >= s[best[-1]] - 1e-9 for v in part.score)
        assert part["rank"].tolist() == list(range(1, 21)) and q not in set(part.vec_id)
        assert np.allclose(part.score, [x[q] @ x[k] for k in part.vec_id], atol=1e-12)
        assert part.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist() == part.vec_id.tolist()
    n = len([k for k in range(0, len(x), 20)])
    assert found / (20 * n) >= 0.9
    copies = got[got.query_id == 200].sort_values("rank").vec_id.tolist()
    copies = [k for k in copies if 200 < k < 230]
    assert copies == list(range(201, 201 + len(copies))) and len(copies) > 3
    assert hnsw.search(hnsw.build_index(vectors.limit(0)), vectors.limit(0)).count() == 0


def test_repeats_and_huge_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8))
    x[100:200] *= 1e200
    x[200:] *= 1e-200
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows + rows[20:21] * 2 + rows[120:121] * 30 + rows[7:8] * 30, "vec_id long, embedding array<double>")
    vectors = hnsw.clean(df)
    got = hnsw.search(hnsw.build_index(vectors, shard_rows=200), vectors.where("vec_id % 20 = 0"), 20).toPandas()
    for q in range(0, 300, 20):
        part = got[got.query_id == q].sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21)) and part.vec_id.nunique() == 20
    part = got[got.query_id == 0].sort_values("rank")
    with np.errstate(over="ignore"):
        s = x @ x[0]
    s[0] = -np.inf
    best = sorted(range(300), key=lambda k: (-s[k], k))[:20]
    assert len(set(best) & set(part.vec_id)) >= 18


# URLs


def test_urls(spark):
    urls = [f"https://m.a{k}.example.com/en/{k}" for k in range(60)] + [f"http://b{k}.example.com/en/7{k}" for k in range(40)] + [f"http://b{k}.example.com/fr/7{k}" for k in range(9)]
    odd = [None, "", "no scheme", "HTTP://EXAMPLE.COM:80/en/7?x=/en/", "x://", "a://b://c/d", "http://notcom/en/", "http://org/es/#t", "http://Éx.NET/de/8", "http://q.example.net/de/81#f"]
    df = spark.createDataFrame(list(enumerate(urls + odd)) + [(0, urls[0])], "page_id long, url string").withColumn("score", F.lit(1)).withColumn("r", F.lit(1))
    got = url_markov.judge(df).toPandas()
    by = {(r.page_id): r for r in got.itertuples()}
    at = len(urls)
    assert len(got) == len(urls) + len(odd) + 1
    assert (by[0].host, by[0].path, by[0].rule, by[0].verdict) == ("m.a0.example.com", "/en/0", "com/en/", "block")
    assert (by[61].rule, by[61].verdict) == ("example.com/en/7", "allow")
    assert [(by[at + k].host, by[at + k].path) for k in (0, 1, 2)] == [("", "")] * 3
    assert (by[at + 3].host, by[at + 3].path, by[at + 3].rule) == ("example.com:80", "/en/7", None)
    assert (by[at + 5].host, by[at + 5].path) == ("b:", "//c/d")
    assert by[at + 6].rule is None and by[at + 7].rule == "org/es/" and by[at + 9].rule == "example.net/de/8" and by[at + 8].host == "Éx.net"
    # The models tell the rules' classes apart on the URLs' characters.
    score = got[got.page_id < 100].drop_duplicates("page_id").set_index("page_id").score.sort_index()
    assert score[60:].mean() > score[:60].mean()
    assert set(got.verdict) <= {"allow", "block"}
    assert url_markov.judge(df.limit(0)).count() == 0
    assert set(url_markov.judge(df.where("page_id >= 100")).where("rule is null").toPandas().verdict) <= {"allow", "block"}


def test_url_rules(spark):
    """Each rule of the contract gives its own verdict; the longest that fits wins."""
    want = {
        "http://com/en/": ("com/en/", "block"), "http://a.COM/en/7": ("com/en/", "block"), "http://a.example.com/en/71": ("example.com/en/7", "allow"), "http://example.com/en/6": ("com/en/", "block"),
        "http://net/de/": ("net/de/", "allow"), "http://a.b.NET/de/8?x": ("net/de/", "allow"), "http://example.net/de/7": ("net/de/", "allow"), "http://a.example.net/de/#8": ("net/de/", "allow"),
        "http://example.net/de/8": ("example.net/de/8", "block"), "http://a.example.net/de/81": ("example.net/de/8", "block"), "http://a.org/es/": ("org/es/", "block"),
    }
    got = url_markov.judge(spark.createDataFrame(list(enumerate(want)), "page_id long, url string")).orderBy("page_id").collect()
    assert {u: (r.rule, r.verdict) for u, r in zip(want, got)} == want


def brute_score(url, train, order=5):
    """Mean difference of log probabilities of (url, verdict) models, by Witten-Bell down from ``order`` characters of context."""
    fold = lambda u: "\x02" * order + "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in u)
    letters = {c for u, _ in train for c in fold(u)[order:]}
    n = {v: {} for v in ("allow", "block")}
    for u, v in train:
        x = fold(u)
        for i in range(order, len(x)):
            for k in range(order + 1):
                n[v].setdefault(x[i - k : i], {}).setdefault(x[i], 0)
                n[v][x[i - k : i]][x[i]] += 1

    def p(v, x, i):
        out = 1 / (len(letters) + 1)
        for k in range(order + 1):
            seen = n[v].get(x[i - k : i], {})
            if seen:
                out = (seen.get(x[i], 0) + len(seen) * out) / (sum(seen.values()) + len(seen))
        return out

    x = fold(url)
    return float(np.mean([np.log(p("allow", x, i)) - np.log(p("block", x, i)) for i in range(order, len(x))])) if url else 0.0


def test_url_of_a_megabyte(spark):
    """A URL's text does not go with each of its characters."""
    urls = ["http://a.com/en/" + "".join(chr(97 + (k * k) % 26) for k in range(1 << 20)), "http://b.example.com/en/7", "http://c.org/fr/", "http://d.example.com/en/71"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert "url" not in url_markov.places(url_markov.with_key(df)).columns
    got = {r.page_id: r for r in url_markov.judge(df).collect()}
    assert len(got) == 4 and (got[0].rule, got[1].rule, got[2].rule) == ("com/en/", "example.com/en/7", None)


def test_url_order(spark, sf_dir):
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(60).collect()] + [f"http://a{k}.example.com/en/7{k}" for k in range(20)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_markov.judge(df, order=2).join(df, "page_id").withColumn("aside", F.pmod(F.xxhash64(F.lit("cut"), "url"), F.lit(5)) == 0).toPandas()
    known = {r.url: (r.verdict if isinstance(r.rule, str) else None, r.aside) for r in got.itertuples()}
    train = [(u, v) for u, (v, aside) in known.items() if v and not aside]
    assert all(abs(r.score - brute_score(r.url, train, 2)) < 1e-9 for r in got.itertuples())


@pytest.mark.parametrize("most", [10**6, 0])
def test_url_scores(spark, sf_dir, monkeypatch, most):
    monkeypatch.setattr(url_markov, "BROADCAST_ROWS", most)
    urls = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(150).collect()] + [f"http://a{k}.example.com/en/7{k * k}" for k in range(30)] + ["", "x", "http://É.COM/en/😀", "http://a.com/en/" + "q" * 3000]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    got = url_markov.judge(df).join(df, "page_id").withColumn("aside", F.pmod(F.xxhash64(F.lit("cut"), "url"), F.lit(5)) == 0).toPandas()
    known = {r.url: (r.verdict if isinstance(r.rule, str) else None, r.aside) for r in got.itertuples() if isinstance(r.url, str)}
    train = [(u, v) for u, (v, aside) in known.items() if v and not aside]
    want = {u: brute_score(u, train) for u in known}
    assert {v for _, v in train} == {"allow", "block"}
    assert all(abs(r.score - want.get(r.url, 0.0)) < 1e-9 for r in got.itertuples())
    step = {u: max(-2000, min(2000, int(np.floor(want[u] * 200)))) for u in known}
    held = [(step[u], v) for u, (v, aside) in known.items() if v and aside]
    n = {v: sum(w == v for _, w in held) for v in ("allow", "block")}
    below = lambda t, kind: sum(s < t for s, v in held if v == kind) / max(1, n[kind])
    cut = max({s for s, _ in held}, key=lambda t: (round(below(t, "block") - below(t, "allow"), 12), -t)) / 200
    assert (got.cut == cut).all()
    judged = [r for r in got.itertuples() if not isinstance(r.rule, str)]
    assert judged and all(r.verdict == ("allow" if r.score >= r.cut else "block") for r in judged)


# Mixing


def test_mix(make_docs, documents):
    rows = [(r.doc_id, r.text, None, r.source) for r in documents.collect()] + [(10**6, None, None, None), (10**6 + 1, "a b c", None, None), (None, "x " * 5000, None, "src1"), (3, "again", None, "src2"), (3, "again", None, "src2")]
    docs = make_docs(rows)
    out = entropy_mix.mix(docs).toPandas()
    assert len(out) == len(rows)
    size = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, *_ in rows]
    assert sorted(out["size"]) == sorted(size)
    g = out.fillna({"source": "~"}).groupby("source").agg(words=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), top=("size", "max"), rate=("rate", "first"))
    total, w, cap = 1.5 * sum(size), np.array([5.0, 2, 1] * 20)[: len(g)], 2.0 * g.words.to_numpy()
    lo, hi = 0.0, total
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.minimum(cap, mid * w).sum() < total else (lo, mid)
    assert np.allclose(g.target, np.minimum(cap, hi * w), rtol=1e-9)
    # The dual is solved: rates meet the targets, and are exp(lambda * size) with one lambda for each source, up to the cap.
    met = (out.rate * out["size"]).groupby(out.source.fillna("~")).sum()
    assert np.allclose(met, g.target, rtol=1e-9)
    free = out[(out.rate < 2) & (out["size"] > 0) & (out.target > 0)]
    lam = (np.log(free.rate) / free["size"]).groupby(free.source.fillna("~"))
    assert np.allclose(lam.min(), lam.max(), rtol=1e-9, atol=1e-15) and (lam.max() > 0).any() and (lam.max() < 0).any()
    assert (out.rate <= 2).all() and (out.copies >= np.floor(out.rate)).all() and (out.copies <= np.ceil(out.rate)).all()
    assert ((g.taken - g.target).abs() <= g.top).all() and (out.taken <= 2 * out["size"]).all()
    again = entropy_mix.mix(docs.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(out[key].fillna(-1).to_numpy().tolist()) == sorted(again[key].fillna(-1).to_numpy().tolist())
    assert entropy_mix.mix(make_docs([])).count() == 0


def test_global_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    got = global_rank(df, F.col("x"), rows_per_part=90).toPandas()
    assert (got["rank"] == got.x + 1).all()
    assert spark.range(1).select(ascii_lower(F.lit("AÉz")).alias("t")).first().t == "aÉz"


# Languages


def test_languages(spark, sf_dir, make_docs, documents):
    out = lang_embed.op8(spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert out.held_out.tolist() == [zlib.crc32(str(d).encode()) % 4 == 2 for d in out.doc_id]
    assert (out.lang == out.lang_pred)[out.held_out].mean() >= 0.95
    assert out.score.between(0, 1).all() and out.rejected.mean() <= 0.02
    model = lang_embed.train(documents, sample=150)
    got = {r.doc_id: r for r in lang_embed.predict(make_docs([(1, None), (2, ""), (3, "123 !?"), (4, "the of and"), (5, "ж" * 50), (6, "und der die ß " * 20000)]), model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and all(got[k].rejected and got[k].score == 0 for k in (1, 2, 3))
    assert got[5].lang_pred in model.langs and got[6].lang_pred == "de"
    one = model.logits(["the of and"])
    assert np.allclose(model.logits(["x", "the of and", "zz zz"])[1], one[0])
    rare = [(k, f"the of and to {k}", "en") for k in range(300)] + [(1000 + k, f"ж щ ъ ы {k} " * 900, "ru") for k in range(6)] + [(2000 + k, "xq zx", "") for k in range(50)]
    few = lang_embed.train(make_docs(rare), sample=30, steps=2000)
    assert few.langs == ["", "en", "ru"] and few.predict(["ж щ ъ", "and to the", "xq zx"])[0] == ["ru", "en", ""]
    none = lang_embed.train(make_docs([(1, "a", None)]))
    assert lang_embed.predict(make_docs([(1, "abc")]), none).first().lang_pred == "und"
    assert lang_embed.predict(make_docs([]), model).count() == 0


# Token files


def test_token_files(spark, tmp_path, make_docs, documents):
    from tokenizers import Tokenizer

    path = arrow_tokens.default_tokenizer()
    tok = Tokenizer.from_file(path)
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(-5, None), (-4, ""), (-3, "a  b \n\n c<|endoftext|>  d "), (-2, "é" * 9000), (-1, " lead")]
    rows.sort()
    out = str(tmp_path / "ids")
    manifest = arrow_tokens.write_tokens(make_docs(rows), out, path, length=64)
    got = arrow_tokens.read_tokens(spark, out, manifest).orderBy("doc_id").collect()
    start, want, stream = 0, [], []
    for d, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream += ids
    assert [tuple(r) for r in got] == want
    back = []
    for f in sorted(p for p in (tmp_path / "ids").iterdir() if p.name.endswith(".arrow") and ".docs." not in p.name):
        file = arrow_tokens.SequenceFile(str(f))
        for k in range(len(file)):
            ids, mask = file[k]
            assert len(ids) == len(mask) == 64
            back += ids[mask].tolist()
    assert back == stream
    assert arrow_tokens.tokens(make_docs([])).count() == 0
    assert arrow_tokens.tokens(make_docs([(None, "a"), (1, "b"), (1, "b")])).count() == 3


def test_encoder_pieces(monkeypatch):
    import random

    from tokenizers import Tokenizer

    monkeypatch.setattr(arrow_tokens, "CACHE_WORDS", 300)
    path = arrow_tokens.default_tokenizer()
    tok, own, rnd = Tokenizer.from_file(path), arrow_tokens.Encoder(path), random.Random(1)
    parts = ["a", "\x00", "Bc", "é", "1", "23", " ", "  ", "\n", "\n\n", ",", ".", "'s", "'", "-", "\t", "\xa0", "<|endoftext|>", "😀", "!", "?", "\x1c", "\u2003", "\u0301", "İ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        ids, sizes = own(pa.array(some))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in some]
