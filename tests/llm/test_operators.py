"""The ten operators against brute force, round trips and the cases that data may hold."""

import hashlib
import itertools
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import chat_format, fixity, hnsw, html_text, language_id, mixing, ngram_join, packing, topk_search, url_filter
from lakeloom.llm.components import connected_components
from lakeloom.llm.queries import FORGED, tokenizer_path

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, rep long, a long, key string, size int"


def docs_of(spark, rows):
    """Documents with further columns that operators use as names of their own."""
    return spark.createDataFrame([(i, t, la, s, None, 1, 2, 3, "k", 4) for i, t, la, s in rows], DOCS)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


# Operator 1


def test_hnsw_recall_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(900, 16)).astype("float32")
    base[100:160] = base[100]  # equal vectors
    base[5] *= 9
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(base)]
    odd = [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [None] + [1.0] * 15, 0), (1003, [float("nan")] * 16, 0), (1004, [float("inf")] * 16, 0), (1005, [], 0), (None, [1.0] * 16, 0), (3, [float(x) for x in base[3]], 1)]  # the last one repeated
    table = hnsw.usable_vectors(vectors_of(spark, rows + odd), allow_zero=False)
    assert table.count() == 900
    got = hnsw.search(hnsw.build_index(table, shard_rows=300), table.where("vec_id % 20 = 0"), k=20).collect()
    exact = base.astype(float)
    hits = 0
    for q in range(0, 900, 20):
        s = (exact * exact[q]).sum(axis=1)
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-s[i], i))[:20]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21)) and q not in {r["vec_id"] for r in own}
        assert [(r["score"], r["vec_id"]) for r in own] == sorted(((r["score"], r["vec_id"]) for r in own), key=lambda x: (-x[0], x[1]))
        assert all(abs(r["score"] - s[r["vec_id"]]) < 1e-9 for r in own)
        hits += len({r["vec_id"] for r in own} & set(best))
    assert hits / 45 / 20 >= 0.95


def test_hnsw_of_large_numbers_and_repeated_ids(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, -1e200]), (2, [1e200, 1.0]), (3, [-1e200, 0.0]), (4, [0.0, 5.0]), (4, [0.0, 7.0])]
    table = hnsw.usable_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), allow_zero=False)
    assert table.count() == 6
    got = hnsw.search(hnsw.build_index(table), table.where("vec_id = 0"), k=20).collect()
    inf = float("inf")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 2, inf), (2, 4, 1e200 * 7.0), (3, 4, 1e200 * 5.0), (4, 1, 0.0), (5, 3, -inf)]
    both = hnsw.search(hnsw.build_index(table), table.where("vec_id = 4"), k=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in both) == [(4, 1, 0, 1e200 * 5.0), (4, 1, 0, 1e200 * 7.0)]


def test_hnsw_shard_takes_memory_in_proportion_to_its_rows():
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(4)
    base = rng.normal(size=(3000, 4))
    rows = pd.DataFrame({"shard": "4:0", "vec_id": np.arange(3000)[::-1], "embedding": list(base[rng.integers(0, 2900, 3000)])})
    tracemalloc.start()
    index = hnsw._index_shard(rows, links=4, beam=4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # A copy of all ids for each vector takes 45 MB here, and 2 GB for a shard of full size.
    assert peak < 8e6
    ids, starts = np.frombuffer(index["ids"][0], np.int64), np.frombuffer(index["starts"][0], np.int64)
    vectors = np.repeat(np.frombuffer(index["vectors"][0]).reshape(-1, 4), np.diff(starts), axis=0)
    assert sorted(ids) == list(range(3000)) and all((rows["embedding"][2999 - i] == v).all() for i, v in zip(ids, vectors, strict=True))


def test_hnsw_rounds_of_queries_copy_neither_index_nor_queries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i % 7 else 5).astype("float32")], 0) for i in range(400)]
    table = hnsw.usable_vectors(vectors_of(spark, rows), allow_zero=False)
    index = hnsw.build_index(table, shard_rows=100)
    files = index.inputFiles()
    # A file for each shard: Parquet's writer would hold a task's shards at once.
    assert len(files) == index.count() == 8
    asked = table.where("vec_id % 20 = 0")
    once = {(r.query_id, r.rank): (r.vec_id, r.score) for r in hnsw.search(index, asked, k=5).collect()}
    rounds = hnsw.search(index, asked, k=5, query_block=6)
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in rounds.collect()} == once
    for i in range(0, 400, 20):
        v = np.array(rows[i][1])
        near = sorted((-float((np.array(w) * v).sum()), j) for j, w, _ in rows if j != i and len(w) == len(v))[:5]
        assert [once[i, n][0] for n in range(1, 6)] == [j for _, j in near]
    plan = rounds._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan


def test_hnsw_small_and_empty_tables(spark):
    few = hnsw.usable_vectors(vectors_of(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [1.0], 0)]), allow_zero=False)
    got = hnsw.search(hnsw.build_index(few), few.where("vec_id % 20 = 0"), k=20).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 0.5)]
    none = hnsw.usable_vectors(vectors_of(spark, []), allow_zero=False)
    assert hnsw.search(hnsw.build_index(none), none, k=20).count() == 0


# Operator 2

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_url_rules(spark):
    urls = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://x.net/fr/1", "http://x.net/de/1", "http://com", "no scheme", None, "http://h.com/?://z/", "ftp://example.com#/en/", "http://notexample.com/en/"]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    rules = spark.createDataFrame(RULES + RULES[:1], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[1][2:] == ("www.example.com/en/", "allow")
    assert got[2][2:] == ("net/fr/", "block") and got[3] == ("x.net", "/de/1", None, "block")  # a seed of distrust
    assert got[4] == ("com", "", None, "allow") and got[5] == ("", "", None, "allow") == got[6]
    assert got[7] == ("h.com", "/", "com/", "allow") and got[8][:3] == ("example.com", "", None)
    assert got[9][2] == "com/"
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_propagation_is_personalised_pagerank(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "c", 3)]
    links = spark.createDataFrame(edges, "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 3), ("d", 1), ("z", 4)], "host string, weight long")
    got = {r["host"]: r["rank"] for r in url_filter.propagate(links, seeds, rounds=12).collect()}
    names = "abcdz"
    out = {s: sum(n for x, _, n in edges if x == s) for s in names}
    s = np.array([3, 0, 0, 1, 4]) / 8
    r = s.copy()
    for _ in range(12):
        moved = np.zeros(5)
        for x, y, n in edges:
            moved[names.index(y)] += 0.85 * n / out[x] * r[names.index(x)]
        r = moved + s * (1 - moved.sum())
    assert all(abs(got.get(h, 0) - x) < 1e-12 for h, x in zip(names, r, strict=True))


def test_links_make_hosts_distrusted(spark):
    pages = [(0, "http://good.com/a", '<a href="//nice.org/x">'), (1, "http://bad.net/fr/", ""), (2, "http://fan.org/", "<a HREF='http://bad.net/q'> <a href='/own'>"), (3, "http://nice.org/", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in url_filter.judge(df, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()}
    assert got == {"good.com": "allow", "bad.net": "block", "fan.org": "block", "nice.org": "allow"}


def test_distrust_reaches_hosts_at_any_distance_and_size(spark):
    # A chain of 16 hosts to a blocked one, each linked from 100 others, which thin the distrust out.
    pages = [(0, "http://bad.net/fr/", "")]
    last = "bad.net"
    for hop in range(16):
        pages += [(0, f"http://h{hop}x{i}.org/", f"<a href='http://{last}/'>") for i in range(100 if hop < 9 else 1)]
        last = f"h{hop}x0.org"
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = url_filter.judge(df, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert {r["verdict"] for r in rows} == {"block"} and 0 < min(r["distrust"] for r in rows) < 1e-18


def test_ranks_settle_where_many_rounds_end(spark):
    links = spark.createDataFrame([("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("d", "c", 3), ("c", "e", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 3), ("d", 1), ("z", 4)], "host string, weight long")
    flow = {"b": {"a": 2 / 3}, "c": {"a": 1 / 3, "b": 1, "d": 1}, "e": {"c": 1}}
    x = {"a": 3, "d": 1, "z": 4}
    for h in "bce":
        x[h] = sum(0.85 * p * x[s] for s, p in flow[h].items())
    got = {r["host"]: r["rank"] for r in url_filter.propagate(links, seeds).collect()}
    assert got.keys() == x.keys() and all(abs(got[h] - x[h] / sum(x.values())) < 1e-12 for h in x)


def test_judged_hosts_equal_a_plain_pagerank(spark):
    rng = random.Random(21)
    hosts = [f"h{i}.{rng.choice(['com', 'net', 'org', 'org', 'org'])}" for i in range(60)]
    pages, links, seeds = [], {}, {"allow": {}, "block": {}}
    for n in range(220):
        host, path = rng.choice(hosts), rng.choice(["/", "/es/x", "/fr/", "/de/"])
        to = [rng.choice(hosts) for _ in range(rng.choice([0, 0, 1, 3]))]
        pages.append((n, f"HTTP://{host.upper()}{path}?q", " ".join(f"<a class=x href='https://{x}/y'>t</a><a href='/own'>" for x in to)))
        for x in to:
            if x != host:
                links[host, x] = links.get((host, x), 0) + 1
        kind = "allow" if host.endswith(".com") else "block" if host.endswith(".net") and path in ("/es/x", "/fr/") else None
        if kind:
            seeds[kind][host] = seeds[kind].get(host, 0) + 1

    def ranks(edges, start):
        out = {}
        for (a, _), n in edges.items():
            out[a] = out.get(a, 0) + n
        rank, step = dict(start), dict(start)
        for _ in range(400):
            new = {}
            for (a, b), n in edges.items():
                if a in step:
                    new[b] = new.get(b, 0) + 0.85 * step[a] * n / out[a]
            step = new
            for h, x in new.items():
                rank[h] = rank.get(h, 0) + x
        return {h: x / sum(rank.values()) for h, x in rank.items()}

    trust, distrust = ranks(links, seeds["allow"]), ranks({(b, a): n for (a, b), n in links.items()}, seeds["block"])
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = url_filter.judge(df, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert len(rows) == 220 and {r["verdict"] for r in rows if r["rule"] is None} == {"allow", "block"}
    for r in rows:
        t, d = trust.get(r["host"], 0), distrust.get(r["host"], 0)
        assert abs(r["trust"] - t) < 1e-8 and abs(r["distrust"] - d) < 1e-8
        if r["rule"] is None and abs(t - d) > 1e-7:
            assert r["verdict"] == ("block" if d > t else "allow")


# Operator 3


def test_language_mixture(spark):
    rng = random.Random(3)
    words = {"aa": ["kala", "muna", "tiko", "sapu"], "bb": ["strx", "grmf", "plok", "drsh"]}
    text = lambda la, n: " ".join(rng.choice(words[la]) for _ in range(n))
    train = [(i, text(la, 30), la, "s") for i, la in enumerate(["aa", "bb"] * 20)]
    odd = [(100, None, "aa", None), (101, "", None, None), (102, "123 !? …", "bb", "s"), (103, text("aa", 60) + " " + text("bb", 30), None, "s"), (104, text("bb", 50_000), "aa", "s"), (None, "kala muna", None, None), (103, "kala", None, None)]
    docs = docs_of(spark, train + odd)
    got = language_id.identify(docs, docs_of(spark, train), carry=("source",)).collect()
    assert len(got) == len(train) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(by[i][0]["lang_pred"] == la for i, _, la, _ in train)
    assert [(by[i][0]["lang_pred"], by[i][0]["score"], by[i][0]["languages"]) for i in (100, 101, 102)] == [("und", 0.0, [])] * 3
    mixed = max(by[103], key=lambda r: len(r["languages"]))
    assert mixed["languages"] == ["aa", "bb"] and abs(mixed["shares"][0] - 2 / 3) < 0.02 and mixed["score"] == mixed["shares"][0]
    assert by[104][0]["lang_pred"] == "bb" and by[None][0]["lang_pred"] == "aa"
    assert {r["lang_pred"] for r in language_id.identify(docs, docs_of(spark, [])).collect()} == {"und"}
    assert language_id.identify(docs_of(spark, []), docs).count() == 0


def plain_mixture(text, table):
    """Shares of one text's languages, word by word in plain Python."""
    words = "".join(chr(b) if chr(b).isalpha() and b < 128 else " " for b in text.encode()).lower().split()
    fits = []
    for w in words:
        grams = [f" {w} "[i : i + 3].encode() for i in range(len(w))]
        buckets = [((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761 % 2**32) >> (32 - language_id.BUCKET_BITS) for g in grams]
        fits.append((len(w), [sum(float(table[b][la]) for b in buckets) for la in range(table.shape[1])]))

    def best(langs):
        pi = {la: 1 / len(langs) for la in langs}
        for _ in range(5000):
            new = dict.fromkeys(langs, 0.0)
            for n, f in fits:
                top = max(f)
                parts = {la: pi[la] * np.exp(f[la] - top) for la in langs}
                for la in langs:
                    new[la] += n * parts[la] / sum(parts.values())
            pi = {la: x / sum(n for n, _ in fits) for la, x in new.items()}
        return pi, sum(np.log(sum(pi[la] * np.exp(f[la] - max(f)) for la in langs)) + max(f) for _, f in fits)

    every = range(table.shape[1])
    chosen = [max(every, key=lambda la: sum(f[la] for _, f in fits))]
    pi, like = best(chosen)
    penalty = language_id.PENALTY * np.log(len(words) + 1)
    while len(chosen) < len(every):
        gain = {la: sum(max(0, f[la] - max(f[x] for x in chosen)) for _, f in fits) for la in every if la not in chosen}
        new = max(gain, key=gain.get)
        if gain[new] <= penalty:
            break
        trial, mixed = best([*chosen, new])
        if mixed - penalty <= like or trial[new] < language_id.LEAST_SHARE:
            break
        chosen, pi, like = [*chosen, new], trial, mixed
    return [pi.get(la, 0.0) for la in every]


def test_mixtures_equal_plain_expectation_maximisation():
    rng = random.Random(7)
    words = [["kala", "muna", "tiko", "sapu", "the"], ["strx", "grmf", "plok", "the", "muna"], ["wiewy", "hjeoj", "kala", "qoeb", "strx"]]
    counts = np.full((1 << language_id.BUCKET_BITS, 3), language_id.SMOOTHING)
    for la, own in enumerate(words):
        for w in own:
            for b in language_id.word_grams([w.encode()])[0]:
                counts[b, la] += rng.randint(5, 20)
    table = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    texts = [" ".join(rng.choice(words[rng.choice(mix)]) for _ in range(n)) for mix in ([0], [1, 1, 2], [0, 1, 2], [2, 2, 2, 0], [0, 0, 1]) for n in (1, 6, 40)]
    got = language_id.mixtures([t.encode() for t in texts], table)
    want = np.array([plain_mixture(t, table) for t in texts])
    assert ((want > 0).sum(axis=1) > 1).sum() > 4 and ((got > 0) == (want > 0)).all() and np.abs(got - want).max() < 1e-3


def test_language_of_held_out_documents(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language_id.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.98
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


# Operator 4


def test_fixity_audit_locates_faults(spark):
    schema = "file long, nr long, record string, offset long"
    rows = [(f, n, f"record {f} {n} " + "x" * (n % 7) * 30, 9) for f in (1, 2, None) for n in range(60)] + [(2, None, None, 1)]
    base = spark.createDataFrame(rows, schema)
    leaves = lambda rs: fixity.leaves(spark.createDataFrame(rs, schema), "file", "nr", "nr", "record")
    assert fixity.audit(leaves(rows), leaves(rows[::-1]), span=64, fan=2).count() == 0
    other = [(f, n, r.replace("record", "RECORD") if (f, n) in ((1, 7), (None, 59)) else r, o) for f, n, r, o in rows if r is not None]
    other = [r for r in other if r[:2] != (2, 59)] + [(3, 0, "new", 0)]
    got = sorted((str(r["file"]), str(r["record_id"]), r["status"]) for r in fixity.audit(leaves(rows), leaves(other), span=64, fan=2).collect())
    assert got == [("1", "7", "altered"), ("2", "59", "missing"), ("2", "None", "missing"), ("3", "0", "extra"), ("None", "59", "altered")]
    empty = fixity.leaves(base.limit(0), "file", "nr", "nr", "record")
    assert fixity.audit(empty, empty).count() == 0 and fixity.audit(empty, leaves(rows[:3])).count() == 3


def test_fixity_audit_after_shifts(spark):
    schema = "file long, nr long, id string, record string"
    rng = random.Random(3)
    rows = [(f, n, f"{f}-{n}", f"record {f} {n} " + "x" * rng.randint(0, 90)) for f in (1, 2, 3, 4, None) for n in range(200)]
    rows += [(5, n, None, "") for n in range(300)] + [(5, 300 + n, None, f"same {n % 3}") for n in range(30)]
    leaves = lambda rs: fixity.leaves(spark.createDataFrame(rs, schema), "file", "nr", "id", "record")
    other = []
    for f, n, i, r in rows:
        if (f, n) in ((1, 5), (5, 299), (5, 310)):  # lost within a file
            continue
        if (f, n) in ((2, 7), (None, 0)):  # one byte longer
            r += "y"
        if (f, n) == (3, 50):  # two records change places
            n = 150
        elif (f, n) == (3, 150):
            n = 50
        other.append((f, n, i, r))
        if (f, n) == (4, 100):  # one comes in
            other.append((4, 100, "new", "zz"))
    got = [(r["file"], r["record_id"], r["status"]) for r in fixity.audit(leaves(rows), leaves(other), span=256, fan=4).collect()]
    want = [(1, "1-5", "missing"), (2, "2-7", "altered"), (None, "None-0", "altered"), (3, "3-50", "moved"), (3, "3-150", "moved"), (4, "new", "extra"), (5, None, "missing"), (5, None, "missing")]
    # The last records of file 5 are alike: one of them went, and those after it took other places.
    assert sorted(map(repr, [x for x in got if x[0] != 5 or x[2] != "moved"])) == sorted(map(repr, want))


# Operator 5


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = {i: i for i, _ in rows}

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (i, a), (j, b) in itertools.combinations([(r[0], s) for r, s in zip(rows, sets, strict=True)], 2):
        both = len(a & b)
        if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
            x, y = top(i), top(j)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), top(i)) for (i, _), s in zip(rows, sets, strict=True))


def near_copies(rng, n):
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(n):
        if rows and rng.random() < 0.65:
            w = rng.choice(rows).split() or ["x"]
            for _ in range(rng.randint(0, max(1, len(w) // 45))):
                w[rng.randrange(len(w))] = word()
            rows.append("\t ".join(w) if rng.random() < 0.2 else " ".join(w))
        else:
            rows.append(" ".join([word() for _ in range(rng.choice([1, 3, 5, 6, 30, 90]))] + (passage if rng.random() < 0.3 else [])))
    return rows


def test_jaccard_classes_match_brute_force(spark):
    rng = random.Random(5)
    texts = near_copies(rng, 260) + [None, "", " \n", "É é", "é é", "ONE Two", "one two", "a b c d e", "A B C D E f"]
    ids = rng.sample(range(-50, 5000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    got = ngram_join.jaccard_classes(docs_of(spark, [(i, t, "x", "s") for i, t in rows])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_classes(rows)


def test_jaccard_classes_of_odd_tables(spark):
    assert ngram_join.jaccard_classes(docs_of(spark, [])).count() == 0
    # A number on two rows ties their texts together; a row without a number names nothing.
    rows = [(1, "a b c"), (2, "x y z"), (2, "a b c"), (3, "x y z"), (None, "a b c"), (4, None), (4, "q")]
    got = ngram_join.jaccard_classes(docs_of(spark, [(i, t, "x", "s") for i, t in rows])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in got) == [(0, 1, None), (1, 1, 1), (2, 1, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4), (4, 1, 4)]


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return [sum(i != j and bool(a) and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]


@pytest.mark.parametrize("block", [256, 3])
def test_links_inside_a_class_are_counted(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "CLASS_BLOCK", block)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    base = [word() for _ in range(200)]
    # A chain (each links to its nearest only), a family of near copies, exact copies, and others.
    texts = [" ".join(base[i : i + 100]) for i in range(0, 60, 4)]
    for _ in range(25):
        w = [*base[100:], *base[:60]]
        w[rng.randrange(160)] = word()
        w[rng.randrange(160)] = word()
        texts.append(" ".join(w))
    texts += [texts[0], texts[0].upper(), texts[20], None, "", *near_copies(rng, 60)]
    rows = list(zip(rng.sample(range(-50, 5000), len(texts)), texts, strict=True))
    want = brute_links(rows)
    assert len(set(want)) > 5
    got = ngram_join.jaccard_join(docs_of(spark, [(i, t, "x", "s") for i, t in rows])).collect()
    assert {r["doc_id"]: r["n_links"] for r in got} == {i: n for (i, _), n in zip(rows, want, strict=True)}
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_classes(rows)


def test_split_lists_bring_all_pairs_together():
    plain = ngram_join.split_lists
    row, lists, side = plain(np.arange(3), np.array([1, 5, 9]), 7, 4)
    assert row.tolist() == [0, 1, 1, 2, 2, 2] and lists[0] == 0 and len(set(lists.tolist())) == 6 and side[0] == 2
    # Two documents meet in exactly one list of an element, whatever their blocks.
    placed = {d: list(zip(*(x.tolist() for x in plain(np.array([42]), np.array([100]), d, 8)), strict=True)) for d in range(60)}
    for a, b in itertools.combinations(placed, 2):
        met = [(s, t) for _, x, s in placed[a] for _, y, t in placed[b] if x == y and (s != t or s == 2)]
        assert len(met) == 1


def test_operators_leave_no_tables_behind(spark):
    from lakeloom.llm import common

    folder = f"{common.shared_folder(spark)}/lakeloom".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ngram_join.jaccard_join(docs_of(spark, [(i, t, "x", "s") for i, t in enumerate(near_copies(random.Random(4), 40))])).count()
    assert len(set(os.listdir(folder)) - before) == 1  # the result
    docs = docs_of(spark, [(i, f"a b c {i}", "x", "s") for i in range(30)])
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(0, "http://a.com/", "<a href='//b.net/'>"), (1, "http://c.net/fr/", "")], "page_id long, url string, html string")
    leaves = fixity.leaves(docs, "n", "doc_id", "doc_id", "text")
    before = set(os.listdir(folder))
    results = [mixing.mix(docs), url_filter.judge(pages, rules), packing.pack(docs.select("doc_id", F.lit(3).cast("long").alias("length"))), fixity.audit(leaves, leaves)]
    assert [r.count() for r in results] == [30, 2, 30, 0]
    language_id.train(docs)
    assert len(set(os.listdir(folder)) - before) == 4


def test_links_of_odd_tables(spark):
    assert ngram_join.jaccard_join(docs_of(spark, [])).count() == 0
    rows = [(1, "a b c"), (2, "x y z"), (2, "a b c"), (3, "x y z"), (None, "a b c"), (4, None), (4, "q")]
    got = ngram_join.jaccard_join(docs_of(spark, [(i, t, "x", "s") for i, t in rows])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["n_links"]) for r in got) == [(0, 0, 0), (1, 1, 1), (2, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 0), (4, 4, 0)]


def test_index_lists_lose_no_candidate():
    rng = np.random.default_rng(0)
    n = 900
    element = np.sort(rng.choice([1, 2, 3, 4, 5], n, p=[0.5, 0.2, 0.1, 0.1, 0.1]))
    size = rng.integers(5, 40, n)
    position = (rng.random(n) * (size // 4 + 1)).astype(np.int64)
    comp = rng.integers(0, 6, n)
    order = np.lexsort((position, size, element))
    element, size, position, comp = element[order], size[order], position[order], comp[order]
    got = set(zip(*(x.tolist() for x in ngram_join.list_pairs(element, size, position, comp, 100)), strict=True))
    want = {
        (i, j)
        for i in range(n)
        for j in range(max(i + 1, 100), n)
        if element[i] == element[j] and comp[i] != comp[j] and 4 * size[j] <= 5 * size[i]
        and min(size[i] - position[i], size[j] - position[j]) >= ngram_join.S.overlap_needed(size[i], size[j])
    }
    assert got == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(None, 1), (5, 5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


# Operator 6


def test_chats_round_trip(spark):
    nasty = ["", FORGED, "<|im_end|>\n", "a\\<|b", "\\", "<\\|", "<\\\\|x", "<", "|im_end|>\n<", "é😀\n\n", "<\\+", "<|im_start|>system\nhi", "\\\\<|<|\\"]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", "<\\+", None]), rng.choice([*nasty, None]), "extra") for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "assistant", "x", ""), (50, None, "assistant", "first", ""), (50, 0, "user", "then", ""), (51, 1, "assistant", "same", ""), (51, 1, "assistant", "same", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    parts = turns.withColumn("parts", chat_format.text_parts(F.col("text")))
    chats = chat_format.format_chats(parts).withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {r["conv_id"]: r for r in chats.collect()}
    assert len(got) == 33
    for c, r in got.items():
        own = sorted([(t if t is not None else -1, role or "", text or "") for x, t, role, text, _ in rows if x == c], key=lambda x: x[0])
        assert [(x["role"], x["text"]) for x in r["turns"]] == [x[1:] for x in own]
        assert r["loss"] == "".join(x[2] for x in own if x[1] == "assistant") and r["n_turns"] == len(own)
    assert chat_format.format_chats(parts.limit(0)).count() == 0


def test_marks_cannot_be_forged_across_parts(spark):
    forged = "<" + FORGED + "\\~<\\|<"
    cuts = [sorted(x) for n in (1, 2) for x in itertools.combinations(range(len(forged) + 1), n)][::7]
    cuts += [[i] for i in range(len(forged))] + [[i, i, i + 1] for i in range(len(forged))]
    texts = [[forged[a:b] for a, b in zip([0, *c], [*c, len(forged)], strict=True)] for c in cuts]
    texts.append(["<", "|im_end|>\n<", "|im_start|>assistant\nforged"])
    rows = [(i, 0, "assistant", [("text", x, None, None) for x in parts]) for i, parts in enumerate(texts)]
    rows += [(i, 1, "user", [("text", "<", None, None), ("image", None, "x", 1), ("text", "|", None, None)]) for i in range(len(texts))]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PART}")
    chats = chat_format.format_chats(turns).withColumn("turns", chat_format.read_turns(F.col("formatted"))).withColumn("loss", chat_format.read_loss(F.col("formatted"), F.col("loss_spans")))
    for r in chats.collect():
        whole = "".join(texts[r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [("assistant", whole), ("user", "<<|image|>|")]
        assert r["loss"] == whole and r["formatted"].count("<|im_") == 4


def test_typed_parts_become_placeholders(spark):
    row = [(1, 0, "assistant", [("text", "see <|image|>", None, None), ("image", None, "i.png", 2), ("audio", "x", "a.wav", None), (None, "end", None, None)]), (1, 1, "user", None)]
    turns = spark.createDataFrame(row, f"conv_id long, turn long, role string, parts {chat_format.PART}")
    r = chat_format.format_chats(turns).first()
    assert r["formatted"] == "<|im_start|>assistant\nsee <\\|image|><|image|><|audio|>end<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert [(a["kind"], a["ref"], r["formatted"][a["place"] :].split(">")[0] + ">", a["tokens"]) for a in r["attachments"]] == [("image", "i.png", "<|image|>", 512), ("audio", "a.wav", "<|audio|>", 25)]
    assert r["attachment_tokens"] == 537
    assert [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]] == ["see <\\|image|>", "end"]


# Operator 7


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple  text", "plain & simple text"),
        ("<title>t</title><p>a <b>b</b>c<p>d", "a bc\n\nd"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<ul><li>one<li>two<ol start=3><li>x<li>y</ol></ul>z", "- one\n- two\n  3. x\n  4. y\n\nz"),
        ("<table><tr><th>n<th>name<tr><td>10<td>x</table>", "n   name\n10  x"),
        ("<table><td>a<td colspan=2>b<td>c<tr><td>dd<td><td>e<td>f</table>", "a   b     c\ndd     e  f"),
        ("<pre>a\n  b\n\nc</pre>d", "a\n  b\n\nc\n\nd"),
        ("a<br>b</br>c", "a\nb\nc"),
        ("<p hidden>x</p><p style='Display : none'>y</p><script>if (a<b) '</p>'</script><template>t</template><i>z</i>", "z"),
        ("<details><summary>s</summary>in</details><details open>out</details>", "s\nout"),
        ("</p></div>a<unknown>b</unknown></table>", "ab"),
        ("x < y <3 > z", "x < y <3 > z"),
        ("<!-- <p>no</p> -->yes<!-- open", "yes"),
        ("<a title=\"x>y\">in</a><img alt='pic'>", "inpic"),
        ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
        ("<table>lost<tr>text<td>cell</table>", "lost\ntext\n\ncell"),
    ],
)
def test_rendering(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<a title=Tom's>first words</a> it's <b>x</b>", "first words it's x"),
        ("<p title=x'hidden>seen</p>", "seen"),
        ("<a ' title=\"x>y\">in</a> <i class = 'a>b'>out</i>", "in out"),
        ("a<!-->b<!--->c<!-- no -->d", "abcd"),
        ("a<svg><title>no</title><defs/><style/><rect/><text x=1>drawn</text><desc>no</desc></svg>b", "a\ndrawn\nb"),
        ("<svg><g><p>out</p>of it", "out\n\nof it"),
    ],
)
def test_rendering_of_malformed_tags_and_drawings(page, text):
    assert html_text.render(page) == text


def test_no_word_is_lost_by_stray_quotes_and_empty_comments():
    rng = random.Random(6)
    bits = ["<b title=Tom's>", "</b>", "<p title=x\"y>", "</p>", "<i '>", "</i>", "<!-->", "<!--->", "<!-- no -->", "<u \">", "</u>", "it's", "\"", "<svg><text>", "</text></svg>", "<a href=\"x>y\">", "</a>"]
    for _ in range(400):
        page = "".join(rng.choice(bits) + f" w{i} " for i in range(40))
        page = page.replace("</text></svg>", "") if "<svg>" not in page else page
        assert sorted(re.findall(r"w\d+", html_text.render(page.replace("</text></svg>", "</text></svg><p>")))) == sorted(f"w{i}" for i in range(40))


def test_rendering_survives_anything():
    assert html_text.render("<div>" * 50_000 + "deep") == "deep"
    assert html_text.render("<table><tr><td>" * 2000 + "deep").strip() == "deep"
    html_text.render('<a "' * 20_000)
    html_text.render('<a "' * 20_000 + ">")
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "<b>", "</b>", "<pre>", "</pre>", "<div", ">", '"', "&lt;", "<!--", "-->", "<br>", "<h1>", "</h2>", "<select><option>", "<dd>"]
    for _ in range(400):
        page = "".join(rng.choice(bits) + rng.choice(["", f"w{i} "]) for i in range(40))
        html_text.render(page)
    tags = [b for b in bits if b not in ("<div", ">", '"', "<!--", "-->", "&lt;")]
    for _ in range(400):  # whole tags only: no word is lost or doubled
        page = "".join(rng.choice(tags) + f" w{i} " for i in range(40))
        assert sorted(re.findall(r"w\d+", html_text.render(page))) == sorted(f"w{i}" for i in range(40))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("a&#" + "9" * 5000 + ";b &#x" + "0" * 5000 + "41; &#0065; &#0;", "a\ufffdb A A \ufffd"),
        ("<table><tr><td colspan=" + "9" * 5000 + ">a<td>b<tr><td rowspan='²'>c</table>", "a  b\nc"),
        ("<ol start=" + "9" * 5000 + "><li>a</ol>", "1. a"),
        ("<div>" * 205 + "<div hidden>secret<b>no<p>no</p>no</b>no</div>seen<p>too" , "seen\ntoo"),
        ("<div>" * 205 + "a<b>x</b>y<p style='visibility:hidden'>no</p>z", "axy\nz"),
        ("a\u00a0\u00a0b \u3000 c&nbsp;", "a\u00a0\u00a0b \u3000 c\u00a0"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<td>d<tr><td>e</table>", "a  b\n   c  d\ne"),
        ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e</table>", "a  b  c\nd     e"),
        ("<table><tr><td>one<br>two<td>x<tr><td><table><tr><td>1<td>2<tr><td>33<td>4</table><td>y</table>", "one    x\ntwo\n1   2  y\n33  4"),
        ("<div style='visibility:hidden'>no<ul><li>no<b style='visibility: visible'>yes</b>no</ul></div>out", "- yes\n\nout"),
        ("<p style='visibility:collapse'>no<p hidden>no<p hidden style='display:block'>yes", "yes"),
        ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table>", "yes"),
        ("<svg style='visibility:hidden'><text>no</text><g style='visibility:visible'><text>yes</text></g></svg>", "yes"),
    ],
)
def test_rendering_of_numbers_depth_spaces_and_spans(page, text):
    assert html_text.render(page) == text


def plain_render(tokens):
    """Words and breaks to text: the strongest break between two words counts, none at the ends."""
    out, gap = "", 0
    for kind, x in tokens:
        if kind == "break":
            gap = max(gap, x)
        else:
            out += ("\n" * gap if gap else " ") * bool(out) + x
            gap = 0
    return out


def test_rendering_equals_a_plain_renderer():
    rng = random.Random(12)
    count = itertools.count()

    def grow(depth, shown):
        """(html, tokens) of a random run of words and elements."""
        page, tokens = "", []
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["word", "word", "b", "i", "div", "section", "p", "none"]) if depth else "word"
            if kind == "word":
                w = f"w{next(count)}"
                page += rng.choice([" ", "\n\t ", "  "]) + w.replace("w", rng.choice(["w", "&#119;", "&#x77;"])) + " "
                tokens += [("word", w)] if shown else []
            elif kind == "none":
                inner, _ = grow(depth - 1, False)
                page += f"<section hidden>{inner}</section>"
            elif kind == "p":  # no blocks inside; its end tag may be left out, as a block or an end follows
                w = f"w{next(count)}"
                page += f"<p> {w} <b>{w}x</b>" + rng.choice(["</p>", "<div></div>", "<p></p>"])
                tokens += [("break", 2), ("word", w), ("word", w + "x"), ("break", 2)] if shown else []
            else:
                inner, own = grow(depth - 1, shown)
                page += f"<{kind}>{inner}</{kind}>" if kind in "bi" else f"<{kind.upper()} class=x>{inner}</{kind}>"
                step = [("break", 1)] if kind in ("div", "section") and shown else []
                tokens += step + own + step
        return page, tokens

    for _ in range(500):
        page, tokens = grow(4, True)
        assert html_text.render(f"<body>{page}</body>") == plain_render(tokens)


def test_one_long_cell_does_not_pad_all_rows():
    page = "<table>" + "<tr><td>a<td>b" * 300 + "<tr><td>" + "long " * 20_000 + "<td>c</table>"
    text = html_text.render(page)
    assert len(text) < 110_000 and text.startswith("a  b\n")
    sparse = "<table>" + "".join(f"<tr><td rowspan=9999 colspan=1000>w{i}" for i in range(1500)) + "</table>"
    assert len(html_text.render(sparse)) < 20_000 and sorted(re.findall(r"w\d+", html_text.render(sparse))) == sorted(f"w{i}" for i in range(1500))


def test_hidden_text_stays_hidden_at_any_depth():
    rng = random.Random(8)
    for depth in (0, 198, 199, 200, 201, 300):
        for _ in range(60):
            page, n, shut = ["<div>" * depth], 0, 0
            for _ in range(30):
                tag = rng.choice("b i p div ul li".split())
                if rng.random() < 0.2 and not shut:
                    page.append("<section hidden>")
                    shut = 1
                elif rng.random() < 0.2 and shut:
                    page.append("</section>")
                    shut = 0
                page.append(f"<{tag}> {'no' if shut else 'w'}{n} </{tag}>")
                n += not shut
            text = html_text.render("".join(page))
            assert "no" not in text and re.findall(r"w\d+", text) == [f"w{i}" for i in range(n)]


def test_extract_table(spark):
    pages = spark.createDataFrame([(1, "<p>a<p>b", "x"), (2, None, "y"), (None, "c", "z"), (1, "<p>a<p>b", "x")], "page_id long, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_lines"]) for r in got) == [(0, "c", 1), (1, "a\n\nb", 3), (1, "a\n\nb", 3), (2, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


# Operator 8


@pytest.mark.parametrize("seed", [0, 1])
def test_topk_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(700, 8)) * rng.lognormal(0, 1.2, size=(700, 1)) * (1 if seed else 0.01)
    v[300:340] = v[300]
    v[10] = 0
    rows = [(i, [float(np.float32(y)) for y in x], 0) for i, x in enumerate(v)] + [(900, None, 0), (1000, [None] * 8, 0), (1100, [float("inf")] * 8, 0), (1200, [1.0], 0)]
    table = hnsw.usable_vectors(vectors_of(spark, rows), allow_zero=True)
    got = topk_search.search(table, table.where("vec_id % 100 = 0"), k=10, scale=1024, shard_rows=200).collect()
    whole = np.floor(v.astype("float32").astype(float) * 1024).astype(np.int64)
    want = []
    for q in range(0, 700, 100):
        s = whole @ whole[q]
        best = sorted((i for i in range(700) if i != q), key=lambda i: (-s[i], i))[:10]
        want += [(q, n + 1, i, int(s[i])) for n, i in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert topk_search.search(table.limit(0), table.limit(0), k=10, scale=1024).count() == 0


def test_topk_of_large_numbers_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.choice([0, 3, 7, 12, 30])).tolist()) for i in range(150)]
    rows += [(100, [1e307, -1e307, 1e307, 1.0]), (200, [-1e307, 1e307, 2.0, 1.0]), (300, [1e7, -1e7, 1e7, 1.0]), (300, [3.0, 2.0, 1.0, 0.5])]
    table = hnsw.usable_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), allow_zero=True)
    got = topk_search.search(table, table.where("vec_id % 100 = 0"), k=10, scale=1024, shard_rows=40).collect()
    whole = [(i, [int(Fraction(x) * 1024 // 1) for x in v]) for i, v in rows]
    want = []
    for q, v in whole:
        if q % 100 == 0:
            scores = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w, strict=True)))), i) for i, w in whole if i != q]
            want += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:10])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


# Operator 9


def check_bins(rows, capacity):
    """Gapless from 0, no bin over capacity; returns the number of bins."""
    bins = {}
    for length, b, at in rows:
        bins.setdefault(b, []).append((at, length))
    for items in bins.values():
        at = 0
        for begin, length in sorted(items):
            assert begin == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plans_hold_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100])
    counts = {n: rng.choice([0, 1, 2, 5, 40]) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
    rows, seen = [], {}
    for r in packing.plan_bins(counts, capacity).itertuples():
        for i in range(r.items):
            seen.setdefault(r.length, []).append(r.rank + i)
            rows.append((r.length, r.bin + i // r.per_bin, r.offset + i % r.per_bin * r.length))
    assert {n: sorted(x) for n, x in seen.items()} == {n: list(range(c)) for n, c in counts.items() if c}
    gaps = []  # item by item, longest first, into the tightest gap
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    assert check_bins(rows, capacity) <= len(gaps)


def test_large_items_match_greedily():
    plan = packing.plan_bins({60: 2, 40: 1, 35: 2, 41: 1, 5: 3}, 100)
    by_bin = {}
    for r in plan.itertuples():
        for i in range(r.items):
            by_bin.setdefault(r.bin + i // r.per_bin, []).append(r.length)
    assert sorted(map(sorted, by_bin.values())) == [[5, 5, 35, 41], [5, 35, 60], [40, 60]]


def test_packed_documents_keep_their_tokens(spark):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    alphabet = "aZéßÉ'.,!|<> 09́ªµΣσç İ\n\t"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 5, 60, 900]))) for _ in range(150)] + [None, "", "<|endoftext|>x <|startoftext|>", "don't 'S DOGS'", "word " * 400]
    rows = [(i // 2 if i > 140 else i, t, "x", "s") for i, t in enumerate(texts)] + [(None, "a b", None, None)] * 2
    capacity = 100
    got = packing.pack_documents(docs_of(spark, rows), tokenizer_path(), capacity).collect()
    check_bins([(r["length"], r["sequence_id"], r["offset"]) for r in got], capacity)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t, _, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i or -1, n, at, np.array(ids[at : at + capacity], "<u4").tobytes()) for n, at in enumerate(range(0, len(ids), capacity))]
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], bytes(r["ids"])) for r in got) == sorted(want)
    assert packing.pack_documents(docs_of(spark, []), tokenizer_path()).count() == 0


def test_packing_of_clashing_names_and_repeated_rows(spark):
    rows = [(n, n % 5, None if n % 3 else "x", -1, 7.5, "i") for n in range(1, 60)] + [(3, None, None, None, None, None)] * 400
    names = "length long, rank long, `block.x` string, sequence_id long, offset double, item string"
    items = spark.createDataFrame(rows, names).withColumns({"hash": F.lit(1), "copies": F.array(F.lit(2)), "before": F.lit("b"), "start": F.lit(0), "turn": F.lit(0), "first": F.lit(0)})
    got = packing.pack(items, 100)
    assert got.columns == [c for c in items.columns if c not in ("sequence_id", "offset")] + ["sequence_id", "offset"]
    got = got.collect()
    assert len(got) == len(rows)
    assert check_bins([(r["length"], r["sequence_id"], r["offset"]) for r in got], 100) == -(-sum(r[0] for r in rows) // 100)
    key = lambda x: repr(x)
    assert sorted([(r["length"], r["rank"], r["block.x"], r["item"]) for r in got], key=key) == sorted([(a, b, c, f) for a, b, c, _, _, f in rows], key=key)
    again = packing.pack(items.repartition(5), 100).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    with pytest.raises(ValueError):
        packing.pack(items.limit(3).withColumn("length", F.lit(101).cast("long")), 100)
    assert packing.pack(items.limit(0), 100).count() == 0


# Operator 10


def test_targets_fill_by_weight():
    sizes = [("b", 100), ("a", 10), (None, 40), ("c", 50)]
    got = mixing.targets(sizes)
    assert sum(got.values()) == 300 and all(got[s] <= 2 * n for s, n in sizes)
    assert got["a"] == 20 and got["c"] / 2 == got[None] / 3 or got[None] == 80
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0}


def test_pivotal_rounding_keeps_sums_and_chances():
    sizes = [random.Random(i).randint(1, 50) for i in range(40)]
    chances = [0.3] * 40
    total, hits = sum(s * p for s, p in zip(sizes, chances, strict=True)), np.zeros(40)
    for seed in range(600):
        taken, held, p = mixing.pivotal(list(range(40)), sizes, chances, seed)
        assert sum(x == -1 for x in taken) == (held is not None)
        kept = sum(s * x for s, x in zip(sizes, taken, strict=True) if x == 1) + (sizes[held] * p if held is not None else 0)
        assert abs(kept - total) < 1e-6
        hits += [p if x == -1 else x for x in taken]
    assert np.abs(hits / 600 - 0.3).max() < 0.1


@pytest.mark.parametrize("last", [False, True])
def test_blocks_keep_sums_and_chances(last):
    sizes = sorted([random.Random(i).choice([1, 2, 5, 40, 300]) for i in range(80)], reverse=True)
    chances = [random.Random(i).choice([0.3, 0.3, 0.7]) for i in range(80)]
    total, hits = sum(s * p for s, p in zip(sizes, chances, strict=True)), np.zeros(80)
    for seed in range(800):
        taken, held, p = mixing.settle_block(list(range(80)), sizes, chances, seed, last)
        assert (held is None) == (-1 not in taken) and not (last and held is not None)
        kept = sum(s * x for s, x in zip(sizes, taken, strict=True) if x == 1) + (sizes[held] * p if held is not None else 0)
        assert abs(kept - total) <= (1 if last else 1e-6)
        hits += [p if x == -1 else x for x in taken]
    # The smallest rows make up for the draws of the others, which 800 runs don't even out.
    off = np.abs(hits / 800 - chances)
    assert off[np.array(sizes) == 300].max() < 0.08 and off[np.array(sizes) == 40].max() < 0.12


def test_a_document_beyond_the_budget_is_left_out():
    taken, held, _ = mixing.settle_block(list(range(5)), [1000, 40, 30, 20, 10], [0.05] * 5, 3, True)
    assert taken[0] == 0 and held is None and abs(sum(s * x for s, x in zip([1000, 40, 30, 20, 10], taken, strict=True)) - 55) <= 45
    taken, held, _ = mixing.settle_block(list(range(5)), [1000, 40, 30, 20, 10], [0.97] * 5, 3, True)
    assert taken[0] == 1


def test_mix_meets_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 50)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rng = random.Random(1)
    rows = [(i, "\x0b".join(["w"] * rng.randint(0, 60)), "x", rng.choice(["s1", "s1", "s2", "s3", None])) for i in range(800)]
    rows += [(1, " a  b ", "x", "s1"), (1, " a  b ", "x", "s1"), (None, "a", "x", "s2"), (None, None, "x", "s2"), (2000, "", "x", "empty")]
    docs = docs_of(spark, rows)
    run = lambda d: sorted(tuple(r) for r in d.select([F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("doc_id", "nth", "size", "source_size", "target", "taken")]).collect())
    out = mixing.mix(docs)
    first = run(out)
    assert len(first) == len(rows) and first == run(mixing.mix(docs.repartition(7)))
    by = {}
    for r in out.collect():
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) <= 30 for (_, target), t in by.items())
    monkeypatch.undo()
    by = {}
    for r in mixing.mix(docs).collect():
        by.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) <= 2 for (_, target), t in by.items())
    assert abs(sum(t for _, t in by) - 1.5 * sum(n for n, _ in by)) < 1e-6
    assert mixing.mix(docs_of(spark, [])).count() == 0
