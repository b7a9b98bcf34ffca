"""Line dedup, decontamination, personal data and repeated bytes against brute force."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import entropy_mix, line_runs, pfp_dedup, pii_disclosure, suffix_decontam

BLANK = " \t\n\x0b\x0c\r"


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# Line dedup


def brute_lines(rows, least):
    keys = [[low(x.strip(BLANK)) for x in (t or "").split("\n")] for _, t in rows]
    ids = {}
    for (d, _), ks in zip(rows, keys, strict=True):
        for k in ks:
            ids.setdefault(k, set()).add(id(ks) if d is None else (d,))
    out = []
    for (d, t), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, ks, strict=True) if not k or len(ids[k]) < least]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("in_place", [100, 0])
def test_lines(make_docs, in_place):
    rows = [(1, "A b\nx\n\ny"), (2, " a B \t\nz"), (3, "a b"), (4, None), (5, ""), (6, "a b\na b\nÉ"), (7, "é\n" + "w " * 20000), (None, "a b"), (3, "q")]
    rows += [(8, "ÉT A"), (9, "Ét a\r"), (10, "Ét A\nét a\n\x0bx"), (11, "ﬁ X\n\n\n"), (12, "ﬁ x\nX"), (13, "ﬁ x\nİ\ni̇")] + [(14, "often\nA b")] * 4
    out = line_runs.line_dedup(make_docs(rows), min_docs=3, batches=3, fanout=2, in_place=in_place).collect()
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out), key=str)
    assert got == sorted(brute_lines(rows, 3), key=str)
    assert line_runs.line_dedup(make_docs([])).count() == 0


def test_line_batches(spark, make_docs):
    runs = line_runs.LineRuns(spark, fanout=2, min_docs=3)
    for k in range(5):
        last = line_runs.add_batch(runs, make_docs([(k, f"same\nown {k}")])).first()
    assert last.kept == "own 4" and [len(x) for x in runs.levels] == [1, 0, 1]
    # Four documents met in the first merge of merges; the fifth finds the key settled.
    assert runs.counts().agg(F.max("n")).first()[0] == 4


@pytest.mark.parametrize("name", ["op4", "op5", "op7"])
def test_against_sql(spark, sf_dir, name):
    module = {"op4": line_runs, "op5": suffix_decontam, "op7": entropy_mix}[name]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = getattr(module, name)(spark, sf_dir).toPandas(), con.execute(getattr(module, f"{name.upper()}_SQL")).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].to_numpy().tolist())) == sorted(map(tuple, want[cols].to_numpy().tolist()))


# Decontamination


def brute_hits(docs, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    out = []
    for d, t in docs:
        w, hit, found = word.findall(low(t)), set(), []
        for i, it in items:
            iw = word.findall(low(it))
            k = min(13, len(iw))
            wins = {tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)} if iw else set()
            places = [j for j in range(len(w) - k + 1) if iw and tuple(w[j : j + k]) in wins]
            if places:
                found.append("" if i is None else str(i))
            hit.update(x for j in places for x in range(j, j + k))
        out.append((d, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [2_000_000, 30])
def test_decontamination(spark, make_docs, monkeypatch, block):
    rng = np.random.default_rng(5)
    vocab = [f"w{k}" for k in range(40)] + ["É", "ß1"]
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(10, say(30)), (9, say(13)), (8, say(5)), (7, ""), (6, None), (5, "Only!!"), (4, say(40))]
    items.append((3, items[0][1]))
    docs = [(k, say(int(rng.integers(0, 60)))) for k in range(30)]
    docs += [(100, "x " * 50 + items[0][1].upper() + " y" * 700), (101, items[1][1] + " " + items[6][1]), (102, None), (103, ""), (104, "only"), (105, items[0][1] + " " + items[0][1]), (105, "zz"), (None, items[2][1])] + [(106, items[1][1])] * 3
    items += [(2, items[5][1]), (None, items[0][1][9:])]
    monkeypatch.setattr(suffix_decontam, "SHARD_WORDS", 150)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = suffix_decontam.contamination(make_docs(docs), bench, block_words=block).collect()
    texts = {i: suffix_decontam.words(t) for i, t in items}
    for r in out:
        for m in r.matches:
            assert m.n >= min(13, len(texts[int(m["item"])] if m["item"] else texts[None]))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in out), key=str)
    assert got == sorted(brute_hits(docs, items), key=str)
    assert suffix_decontam.contamination(make_docs([]), bench).count() == 0
    assert {r.n_items for r in suffix_decontam.contamination(make_docs(docs), bench.limit(0)).collect()} == {0}


def test_hits_are_arrays():
    """A shard full of items of one word each takes memory by its words, not by its matches."""
    import tracemalloc

    words = [f"w{k}".encode() for k in range(1000)]
    bench = suffix_decontam.Benchmark([(k, w.decode()) for k, w in enumerate(words)])
    rng = np.random.default_rng(0)
    docs = [[words[k] for k in rng.integers(0, 1000, 100_000)] for _ in range(10)]
    tracemalloc.start()
    sizes, hits, items, listed = suffix_decontam.shard_hits([bench], docs, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6, peak
    assert hits.tolist() == sizes.tolist() == [100_000] * 10 and not any(listed)
    assert all(len(x) == 1000 for x in items)


def test_longest(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    got = suffix_decontam.longest_matches(make_docs([(1, "x b c d e f y"), (2, "c d e f g h z")]), bench, min_words=3).collect()
    assert {(r.item_start, r.length, r.doc_id, r.doc_start) for r in got} == {(1, 5, 1, 1), (2, 6, 2, 0), (3, 5, 2, 1), (4, 4, 2, 2), (5, 3, 2, 3)}


def brute_longest(docs, items, least):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    out, docs = set(), [(d, word.findall(low(t))) for d, t in docs]
    for i, t in items:
        w = word.findall(low(t))
        for j in range(len(w)):
            best = (0,)
            for d, x in docs:
                for k in range(len(x)):
                    n = 0
                    while j + n < len(w) and k + n < len(x) and w[j + n] == x[k + n]:
                        n += 1
                    best = max(best, (n, -d, -k))
            if best[0] >= least:
                out.add((str(i), j, best[0], -best[1], -best[2]))
    return out


def test_longest_brute(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(2)
    say = lambda n: " ".join(rng.choice(list("abcd"), n))
    items = [(1, say(30)), (2, say(12)), (3, "a"), (4, None)]
    docs = [(k, say(int(rng.integers(0, 40)))) for k in (9, 3, 7, 1, 5)] + [(8, items[0][1]), (2, "q " + items[0][1] + " q")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for shard, block in ((10**6, 10**6), (30, 15)):
        monkeypatch.setattr(suffix_decontam, "SHARD_WORDS", shard)
        got = suffix_decontam.longest_matches(make_docs(docs), bench, min_words=2, block_words=block).collect()
        assert {(r.item_id, r.item_start, r.length, r.doc_id, r.doc_start) for r in got} == brute_longest(docs, items, 2)
    long = " ".join(f"w{k}" for k in range(1500))
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    got = suffix_decontam.longest_matches(make_docs([(4, "x " + long + " y"), (3, long)]), bench).where("item_start = 0").first()
    assert (got.length, got.doc_id, got.doc_start) == (1500, 3, 0)
    (m,) = suffix_decontam.contamination(make_docs([(4, "x " + long + " y")]), bench).first().matches
    assert tuple(m) == ("1", 0, 1, 1500)


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(20):
        seq = rng.integers(0, 4, 200).astype(np.int32)
        sa = suffix_decontam.suffix_array(seq, 3, 13).tolist()
        pad = np.concatenate([seq, np.zeros(13, np.int32)])
        cut = lambda s: tuple(pad[s : s + 13].tolist() if 0 not in pad[s : s + 13] else [*pad[s : s + 13].tolist()[: pad[s : s + 13].tolist().index(0)], 0])  # noqa: B023, E731
        assert sorted(sa) == np.flatnonzero(seq).tolist()
        assert [cut(s) for s in sa] == sorted(cut(s) for s in sa)


# Personal data


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(t):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (k == 1 and any(int(x) > 255 for x in m.group().split("."))) or (k == 2 and not (16 <= len(d) <= 19 and luhn(d))) or (k == 3 and not 8 <= len(d) <= 15):
                continue
            out.append((k, m.start(), m.end()))
    return out


TEXTS = [
    "a..b@x.y.z. c_d@e.f_g@h.i", "x@y x@.y a@b..c a@b.c.", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.0255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111  4111  1111 1111 1111",
    "+49 (30) 1234567. +1 2 +1-800-555-0199-  ++12 3456789", "é😀 mail: joe@ex.org, 😀+33 1 23 45 67 89", None, "", "@", "1 " * 50, "4111111111111111-4111111111111111 5500005555555559 4",
    "a@b.c" * 3, ".a@b.c.d_e@f.g", "x" * 3000 + "@", "a@b" + ".c" * 20000, "1 " * 30000, "a@b.c\n" * 300,
]


def test_personal_data(make_docs, documents):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[0]), (3, "other +49 30 1234567"), (3, TEXTS[3])] + [(1000 + r.doc_id, r.text) for r in documents.collect()]
    out = pii_disclosure.find(make_docs(rows)).collect()
    got = sorted(((r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans if s.kind < 4]) for r in out), key=str)
    assert got == sorted(((d, brute_pii(t)) for d, t in rows), key=str)
    assert pii_disclosure.find(make_docs([])).count() == 0


def test_disclosure(make_docs):
    rows = [(k, f"the quick report by Zorblatt jo@ex.org about weather number {'abcdefghij'[k]}") for k in range(5)]
    rows += [(10, "plain text where zorblatt is named, zorblatts is not"), (11, "nothing of weather here"), (12, "the quick report about weather")] + [(20 + k, "the weather report about quick number") for k in range(10)]
    found = {r.doc_id: r for r in pii_disclosure.find(make_docs(rows), ratio=0.8).collect()}
    text = dict(rows)
    named = {text[d][s.start : s.stop] for d, r in found.items() for s in r.spans if s.kind == 4}
    assert named == {"Zorblatt", "zorblatt"}
    assert [s.kind for s in found[11].spans] == [] and [s.kind for s in found[12].spans] == []
    clean = {r.doc_id: r.text for r in pii_disclosure.sanitise(pii_disclosure.find(make_docs(rows), ratio=0.8)).collect()}
    assert clean[0] == "the quick report by [TERM] [EMAIL] about weather number a"
    assert clean[10] == "plain text where [TERM] is named, zorblatts is not"
    sure = {r.doc_id: r.text for r in pii_disclosure.sanitise(pii_disclosure.find(make_docs([r for r in rows if r[0] != 10]), ratio=0.8)).collect()}
    assert sure[0] == "the quick report by  [EMAIL] about weather number a"


def brute_terms(rows, near, ratio, least):
    """{doc_id: (start, stop) of the disclosing terms} of short ASCII texts."""
    word, terms = re.compile("[A-Za-z]{4,}"), lambda t: {w.lower() for w in word.findall(t)}
    base, met, df_e, df_t = {d: brute_pii(t) for d, t in rows}, {}, {}, {}
    for d, t in rows:
        masked = list(t)
        for k, a, b in base[d]:
            if k == 0:
                masked[a:b] = ["0" if c.isalpha() else c for c in masked[a:b]]
        for w in terms(t):
            df_t.setdefault(w, set()).add(d)
        for k, a, b in base[d]:
            entity = (k, t[a:b].lower() if k < 2 else re.sub("[^0-9]", "", t[a:b]))
            df_e.setdefault(entity, set()).add(d)
            own = "".join(masked) if k == 0 else t
            left, right = own[:a], own[b:]
            if near is None:
                left, right = t, ""
            else:
                left = left if len(left) <= near else re.sub("^[A-Za-z]+", "", left[-near:])
                right = right if len(right) <= near else re.sub("[A-Za-z]+$", "", right[:near])
            for w in terms(left + "\n" + right):
                met.setdefault((w, entity), set()).add(d)
    n, chosen = len(rows), set()
    for (w, e), ds in met.items():
        content = np.log2(n / len(df_e[e]))
        if len(ds) >= least and content > 0 and np.log2(n * len(ds) / (len(df_t[w]) * len(df_e[e]))) >= ratio * content - 1e-12:
            chosen.add(w)
    free = lambda m, d: all(m.end() <= a or m.start() >= b for _, a, b in base[d])
    return {d: sorted((m.start(), m.end()) for m in re.finditer("[A-Za-z]+", t) if m.group().lower() in chosen and free(m, d)) for d, t in rows}


@pytest.mark.parametrize("near", [12, 80, None])
def test_disclosure_brute(make_docs, near):
    rng = np.random.default_rng(6)
    names, mails = ["Zorblatt", "Quimby", "Anna", "Bo", "Wexford"], ["z1@ex.org", "anna@b.net", "q@c.d.com", "+49 30 1234567", "10.0.0.7"]
    common = "report about weather number quick said that with from".split()
    rows = []
    for k in range(90):
        text = []
        for _ in range(int(rng.integers(1, 3))):
            i = int(rng.integers(0, 25))
            if i < 5:
                text += [names[i], *rng.choice(common, int(rng.integers(0, 3))), mails[i], mails[int(rng.integers(0, 5))] if rng.random() < 0.1 else "so"]
            text += [*rng.choice(common, int(rng.integers(0, 9)))]
        rows.append((k, " ".join(text)))
    rows += [(100 + k, f"Zorblatt a{k}@b.c jo@ex.org") for k in range(5)] + [(200, ""), (201, "@ Zorblatt")]
    found = pii_disclosure.find(make_docs(rows), near=near, ratio=0.6).collect()
    got = {r.doc_id: sorted((s.start, s.stop) for s in r.spans if s.kind == 4) for r in found}
    want = brute_terms(rows, near, 0.6, 3)
    assert got == want and sum(map(len, want.values())) > 5


def test_terms_beyond_a_neighbour(make_docs):
    rows = [(k, f"Zorblatt a{k}@b.c jo@ex.org") for k in range(5)] + [(10 + k, f"other words number {k}") for k in range(9)]
    found = pii_disclosure.find(make_docs(rows)).collect()
    assert {(r.doc_id, s.start, s.stop) for r in found for s in r.spans if s.kind == 4} == {(k, 0, 8) for k in range(5)}


def test_terms_of_any_case_rule(make_docs):
    """Letters whose lower case is longer, or that have two lower cases, are found where the text has them."""
    words = ["İSTANBUL", "Istanbul", "ΣΊΣΥΦΟΣ", "STRASSE", "ﬁnder", "Ǆungla"]
    rows = [(10 * j + k, f"{w if k % 2 else w.capitalize() if w.isascii() else w} m{j}@b.c") for j, w in enumerate(words) for k in range(5)] + [(1000 + k, f"other words number {k}") for k in range(60)]
    found = {r.doc_id: r for r in pii_disclosure.find(make_docs(rows)).collect()}
    for d, t in rows[:-60]:
        assert [(s.start, s.stop) for s in found[d].spans if s.kind == 4] == [(0, t.index(" "))], t
    # Other letters are other words, though they look alike in capitals.
    plain = pii_disclosure.find(make_docs([(k, "İSTANBUL m@b.c") for k in range(5)] + [(9, "istanbul")] + rows[-60:])).collect()
    assert [len(r.spans) for r in plain if r.doc_id == 9] == [0]


# Repeated bytes


def brute_repeats(rows):
    seen, out = set(), []
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            s = b[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        out.append((d, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def repeat_texts():
    rng = np.random.default_rng(3)
    base, out = ["".join(rng.choice(list("abé "), 600)) for _ in range(4)], []
    for i in range(40):
        a = int(rng.integers(0, 400))
        noise = "".join(rng.choice(list("xyz"), int(rng.integers(0, 80))))
        out.append(noise + base[i % 4][a : a + int(rng.integers(50, 300))] + noise[::-1] + "a" * int(rng.integers(0, 400)) * (i % 5 == 0) + "ab" * 150 * (i % 7 == 0))
    return [*out, None, "", "k" * 99, "k" * 100, "k" * 101, out[0]]


@pytest.mark.parametrize("many, block", [(4000, 1 << 20), (3, 300)])
def test_repeats(make_docs, monkeypatch, many, block):
    monkeypatch.setattr(pfp_dedup, "MANY_PHRASES", many)
    monkeypatch.setattr(pfp_dedup, "BLOCK", block)
    rows = list(enumerate(repeat_texts()))
    want = brute_repeats([(d, t or "") for d, t in rows])
    for extra in ([], rows[:4]):
        out = pfp_dedup.remove_repeats(make_docs(rows + extra)).collect()
        got = {(r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out}
        assert got == set(want) and len(out) == len(rows + extra)
    assert pfp_dedup.remove_repeats(make_docs([])).count() == 0


def test_repeats_of_rows_without_id(spark):
    """Rows without a doc_id stay apart even where 32-bit hashes of their texts are equal."""
    words = F.concat_ws(" ", *[F.sha2(F.concat_ws("-", F.col("id"), F.lit(k)), 256) for k in range(3)], F.repeat(F.lit("z"), (F.col("id") % 60).cast("int")))
    texts = spark.range(200_000).select(words.alias("text"))
    pairs = [r.t for r in texts.groupBy(F.hash("text")).agg(F.array_sort(F.collect_set("text")).alias("t")).where(F.size("t") > 1).collect()]
    assert pairs, "there are equal 32-bit hashes"
    longer = [a + " and more of it" for a, *_ in pairs]
    rows = texts.unionByName(spark.createDataFrame([(t,) for t in longer], "text string")).select(F.lit(None).cast("long").alias("doc_id"), "text")
    out = pfp_dedup.remove_repeats(rows.repartition(16))
    got = out.where(F.size("spans") > 0).collect()
    # Of each text and its longer form, the later one loses what they share, which is all of the shorter one, and nothing else does.
    assert len(got) == len(pairs) and out.count() == rows.count()
    sizes = sorted(len(a) for a, *_ in pairs)
    assert sorted(sum(s.stop - s.start for s in r.spans) for r in got) == sizes
    assert all(bytes(r.kept) in (b"", b" and more of it") for r in got)


def test_repeats_on_documents(spark, sf_dir, documents):
    want = brute_repeats([(r.doc_id, r.text or "") for r in documents.collect()])
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in pfp_dedup.op10(spark, sf_dir).orderBy("doc_id").collect()]
    assert got == want
