"""URL templates, neighbours, toxicity, the registered queries and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_helpers import EDGE_ROWS, edge_docs
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tradelens.llm import queries, urls
from tradelens.llm.deobfuscate import SIZE, CharModel, disguised, four_grams, tokens
from tradelens.llm.neighbours import codes, nearest
from tradelens.llm.toxicity import THRESHOLD, toxicity

SMALL = "/root/testdata/sf0.001"


# ---- URL templates


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = []
    for verdict, rule in urls.RULES:
        at, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == at or host.endswith("." + at)) and path.startswith(start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def brute_typed(s):
    if re.fullmatch("[0-9]+", s):
        return "{n}"
    if re.fullmatch(r"[0-9]+\.[A-Za-z]{1,5}", s):
        return "{n}." + s.split(".")[1]
    if re.fullmatch("[0-9]{4}-[0-9]{2}(-[0-9]{2})?", s):
        return "{date}"
    if re.fullmatch("[0-9a-f-]{8,}", s) and re.search("[0-9]", s):
        return "{id}"
    return s


def brute_judge(rows):
    """page_id to (host, path, rule, verdict) by walking one host's tree at a time."""
    pages = []
    for i, url in rows:
        host, path = brute_parts(url)
        rule, ruled = brute_rule(host, path)
        parts = [p for p in path.split("/") if p]
        shape = tuple(map(brute_typed, parts[: urls.DEPTH])) + (("**",) if len(parts) > urls.DEPTH else ())
        pages.append((i, host, path, rule, ruled, shape))
    stats = defaultdict(lambda: [0, 0, 0])
    for _, host, _, _, ruled, shape in pages:
        s = stats[host, shape]
        s[0] += 1
        s[1] += ruled is not None
        s[2] += ruled == "block"
    tree = {k: k[1] for k in stats}
    deepest = max((len(t) for t in tree.values()), default=0)
    star = lambda t, level: t[: level - 1] + ("*",) + t[level:]
    for level in range(1, deepest + 1):
        kids = Counter()
        for (host, shape), t in tree.items():
            if len(t) >= level:
                kids[host, t[: level - 1], t[level - 1]] += stats[host, shape][0]
        nodes, total = Counter(), Counter()
        for (host, node, _), n in kids.items():
            nodes[host, node] += 1
            total[host, node] += n
        for (host, shape), t in list(tree.items()):
            if len(t) >= level:
                at = host, t[: level - 1]
                if nodes[at] >= urls.MANY and nodes[at] >= urls.VARIETY * total[at]:
                    if kids[(*at, t[level - 1])] < urls.HEAVY * total[at]:
                        tree[host, shape] = star(t, level)
    for level in range(deepest, 0, -1):
        branch = defaultdict(lambda: [0, 0])
        for (host, shape), t in tree.items():
            if len(t) >= level and t[level - 1] != "*":
                b = branch[host, star(t, level), t[level - 1]]
                b[0] += stats[host, shape][1]
                b[1] += stats[host, shape][2]
        group = defaultdict(lambda: [0, 0, 0])
        for (host, others, _), (n, b) in branch.items():
            g = group[host, others]
            g[0] += n
            g[1] += b
            g[2] += 1
        for (host, shape), t in list(tree.items()):
            if len(t) >= level and t[level - 1] != "*":
                others = star(t, level)
                n, b = branch[host, others, t[level - 1]]
                gn, gb, kids = group[host, others]
                p = (gb + 0.5) / (gn + 1)
                if kids > 1 and abs(b - n * p) <= urls.Z * (n * p * (1 - p)) ** 0.5:
                    tree[host, shape] = others
    whole = (sum(s[2] for s in stats.values()) + 0.5) / (sum(s[1] for s in stats.values()) + 1)
    by_host, by_tree = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for k, s in stats.items():
        for x in (by_host[k[0]], by_tree[k[0], tree[k]]):
            x[0] += s[1]
            x[1] += s[2]
    share = lambda x, prior: (x[1] + urls.SMOOTHING * prior) / (x[0] + urls.SMOOTHING)
    out = []
    for i, host, path, rule, ruled, shape in pages:
        purity = share(by_tree[host, tree[host, shape]], share(by_host[host], whole))
        template = "/" + "/".join(tree[host, shape])
        out.append((i, host, path, rule, ruled or ("block" if purity >= urls.REJECT else "allow"), template))
    return out


def check_urls(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    got = urls.judge_urls(pages).drop("purity").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_judge(rows)))


def test_url_edges(spark):
    check_urls(
        spark,
        [
            (1, None), (2, ""), (3, "no scheme/x"), (4, "http://"), (5, "HTTP://A.Example.ORG/en/1x?y#z"), (5, "http://b.example.org/es/"),
            (6, "x://org"), (7, "x://org/"), (8, "x://notorg/"), (9, "x://É.COM/de/a://b"), (10, "x://com?/fr/"), (None, "x://c.com/fr/" + "a/" * 5000),
            (11, "x://c.com/fr/" + "é" * 100_000), (12, "x://net#f"), (13, "a\n://x.com/de/\n"),
        ],
    )
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_templates(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        host = rng.choice(["a.com", "b.com", "c.net", "c.net", "www.d.com"])
        kind = rng.choice(["de", "de", "fr", "en"])
        tail = rng.choice([str(rng.randrange(9999)), f"{rng.randrange(99)}.html", f"slug-{rng.randrange(400)}", "2024-01-02", "deadbeef01"])
        rows.append((i, f"https://{host}/{kind}/{tail}" + ("/more" if rng.random() < 0.2 else "")))
    check_urls(spark, rows)


@pytest.mark.parametrize("level", [3, 7, 8, 11])
def test_trees_are_as_deep_as_labels_differ(spark, level):
    """Branches that differ at one segment only, and at the eighth or deeper one: each keeps its own purity."""
    rows = []
    for i in range(240):
        parts = ["a"] * 14
        parts[level - 1] = ["good", "bad"][i % 2]
        rows.append((i, "x://h.com/" + "/".join(parts), i % 2 if i < 200 else None))
    pages = spark.createDataFrame(rows, "page_id long, url string, told int")
    got = urls.judge_urls(pages, rules=[], label="told").collect()
    assert {(r.page_id % 2, r.verdict) for r in got} == {(0, "allow"), (1, "block")} and len(got) == 240
    deep = urls.judge_urls(spark.createDataFrame([(1, "x://h.com/" + "a/" * 20_000, 1), (2, "x://h.com/b", 0)], pages.schema), rules=[], label="told")
    assert {r.page_id: r.template for r in deep.collect()} == {1: "/a/a/a/a/a/a/**", 2: "/b"}


# ---- neighbours


def brute_nearest(rows, k):
    ok = [(n, i, np.array(v, float)) for n, (i, v) in enumerate(rows) if i is not None and v and None not in v]
    ok = [(n, i, v) for n, i, v in ok if np.isfinite(v).all() and v.any()]
    out = []
    for n, i, v in ok:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [5, 8192])
def test_neighbours(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, rows[100][1]) for i in range(1000, 1020)] + [(100, rows[3][1]), (200, rows[100][1])]
    rows += [(i, [float(x)] * 8) for i, x in enumerate((1e-30, 1e30, 3.0, -3.0), 300)]
    rows += [(400, None), (500, []), (600, [0.0] * 8), (700, [float("nan")] * 8), (800, [None] + [1.0] * 7), (900, [float("inf")] * 8)]
    rows += [(1100, [1.0, 2.0]), (1101, [1.0, 3.0]), (None, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).withColumn("row", F.lit(0))
    got = nearest(table, F.col("vec_id") % 100 == 0, candidate_rows=block, query_rows=3).collect()
    assert sorted(map(tuple, got)) == brute_nearest(rows, 10)


def test_neighbours_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0])], schema)
    assert [tuple(r) for r in nearest(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert nearest(two.where("false"), F.col("vec_id") == 0).count() == 0
    assert nearest(two, F.lit(False)).count() == 0


def test_code_bounds():
    x = np.random.default_rng(2).normal(size=(200, 64))
    code, scale, rest = codes(x)
    left = np.linalg.norm(x - code * scale[:, None], axis=1)
    assert code.dtype == np.int8 and (left <= rest).all() and (rest < 1.01 * left + 1e-9).all()


# ---- toxicity

GOOD = "the and of to in is that it for was with on anonymous another station nation ration notion".split()
BAD = ["idiot", "stupid", "scum"]


def model():
    text = " ".join(GOOD * 20 + BAD * 4)
    return CharModel(four_grams(text))


def test_four_grams_count_words():
    grams = four_grams("ab, ab")
    a, b = 1, 2
    assert grams[a * SIZE + b] == 2 and grams[(a * SIZE + b) * SIZE] == 2 and grams.sum() == 6 and grams[a] == 2


@pytest.mark.parametrize(
    "written, read",
    [("1d10t", "idiot"), ("idiooooot", "idiot"), ("i.d.i.o.t", "idiot"), ("5tup1d!", "stupid"), ("$cum", "scum"), ("nation", "nation"), ("ST@TION", "station")],
)
def test_restored(written, read):
    assert tokens(written, model()) == [read]
    assert disguised(written) == (written != "nation")


def toxic_rows(n, rng):
    rows = []
    for i in range(n):
        words = [rng.choice(GOOD) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxicity_finds_disguised_words(spark):
    rows = toxic_rows(400, random.Random(1))
    docs = edge_docs(spark, [(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows if i % 4 != 2] + [(1, None), (None, 1)], "doc_id long, toxic int")
    asked = [(900, "the 1d10t of", "s"), (901, "the s t u p i d of", "s"), (902, "the sssscuuum is", "s"), (903, "in 2 0 2 4 b 1 the", "s")]
    got = {r["doc_id"]: r for r in toxicity(docs.unionByName(edge_docs(spark, asked)), labels).collect()}
    for i, _, y in rows:
        assert (got[i]["score"] >= THRESHOLD) == y and 0 <= got[i]["score"] <= 1
    assert [got[i]["score"] >= THRESHOLD for i in (900, 901, 902, 903)] == [True, True, True, False]
    assert [(x["written"], x["read"]) for x in got[900]["restored"]] == [("1d10t", "idiot")]


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity(docs, none).collect()
    assert len(got) == len(EDGE_ROWS) and {r["score"] for r in got} == {got[0]["score"]} and got[0]["score"] < THRESHOLD
    some = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (4, 0)], "doc_id long, toxic int")
    assert toxicity(docs, some).count() == len(EDGE_ROWS)
    assert toxicity(edge_docs(spark, []), some).count() == 0


# ---- registered queries


def test_all_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(d[0] for d in want.description)
    assert sorted(got.columns) == columns
    at = [[d[0] for d in want.description].index(c) for c in columns]
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())


def test_urls_query(spark):
    got = queries.op1_url_templates(spark, SMALL).drop("purity").collect()
    rows = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_judge(rows)))


def test_toxicity_query(spark):
    got = queries.op6_toxicity(spark, SMALL).collect()
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit >= 0.8 * sum(r["toxic"] for r in got) and hit >= 0.85 * sum(r["predicted"] for r in got)


# ---- pipeline


def test_pipeline_stages(spark):
    from test_dedup import brute_fingerprint, plain, roots_of
    from test_spans import brute_pii

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({"score": F.lit("own"), "pii": F.lit(1)})
    docs.cache()
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "exact dedup", "SimHash near-dedup", "PII", "packing"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity(docs.select("doc_id", "text"), labels).collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert clean.columns == docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert sorted(map(tuple, clean.collect())) == sorted(tuple(r) for i, r in rows.items() if scores[i] < THRESHOLD)

    single = corpus_pipeline.drop_copies(spark, docs, SMALL)
    best = {}
    for i, r in rows.items():
        k = plain(r["text"])
        best[k] = min(best.get(k, (1, 0)), (-len(r["text"] or ""), i))
    assert sorted(map(tuple, single.collect())) == sorted(tuple(rows[i]) for _, i in best.values())

    apart = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    ids = sorted(rows)
    prints = [brute_fingerprint(rows[i]["text"]) for i in ids]
    roots = roots_of(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(ids[k] for k in set(roots))

    masked = {r["doc_id"]: r for r in corpus_pipeline.mask_pii(spark, docs, SMALL).collect()}
    for i, r in rows.items():
        assert masked[i]["pii"] == 1 and masked[i]["score"] == "own"
        if brute_pii(r["text"]):
            assert not brute_pii(masked[i]["text"]) and masked[i]["n_chars"] == len(masked[i]["text"])
        elif "[" not in masked[i]["text"]:
            assert tuple(masked[i]) == tuple(r)


def test_pipeline_takes_edges(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        for d in (docs, edge_docs(spark, [])):
            out = stage(spark, d, SMALL)
            out.count()
            if stage is not corpus_pipeline.pack_documents:
                assert out.columns == docs.columns


def test_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.agg(F.sum("length") == F.sum(F.when(F.col("start") == 0, F.col("doc_tokens")))).first()[0]
