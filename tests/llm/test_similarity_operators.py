"""Operators 1, 3 and 8 and the pipeline, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from voxtide.llm import components as components_module
from voxtide.llm import repeats, shingle_join, url_filter
from voxtide.llm.common import materialize, read

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)].append(doc)
    return Counter((doc, len(sets[i]), min((d for d in least[find(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(rows))


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_join_of_hard_rows(hard, empty):
    got = shingle_join.near_duplicates(hard)
    assert result(got) == brute_components([(r["doc_id"], r["text"]) for r in hard.collect()])
    assert shingle_join.near_duplicates(empty).count() == shingle_join.drop_near_duplicates(empty).count() == 0


@pytest.mark.parametrize("tile", [4, 1000])
def test_join_of_chains_and_shared_passages(spark, tile):
    r = random.Random(tile)
    words = [f"v{i}" for i in range(4000)]
    passage = " ".join(r.choices(words, k=60))
    texts = []
    for g in range(14):
        text = r.choices(words, k=r.choice([6, 12, 40, 90, 91]))
        for _ in range(r.choice([1, 2, 9])):
            texts.append(" ".join(text) + (" " + passage if g % 2 else ""))
            text = list(text)
            for _ in range(r.choice([0, 1, 2])):
                text[r.randrange(len(text))] = r.choice(words)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(shingle_join.near_duplicates(docs, tile=tile)) == brute_components(rows)


def test_frequent_shingles_change_the_order_only(spark, monkeypatch):
    docs = read(spark, SF, "documents")
    want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    for least in (1, 2):
        monkeypatch.setattr(shingle_join, "FREQUENT", least)
        assert result(shingle_join.near_duplicates(docs)) == want


def test_documents_that_share_a_passage_are_no_candidates(spark, monkeypatch):
    """A chain in which each document shares a passage with the next is no component to compare pair by pair."""
    r = random.Random(8)
    own = [r.choices([f"u{i}" for i in range(900)], k=12) for _ in range(200)]
    rows = [(i, " ".join(own[i] + r.choices([f"o{k}" for k in range(900)], k=30) + own[(i + 1) % 200])) for i in range(200)] + [(500, "a b c d e f g h i j k l m"), (501, "a b c d e f g h i j k l m n")]
    crowds, tiles = [], shingle_join._tiles
    monkeypatch.setattr(shingle_join, "_tiles", lambda classes, *a: (crowds.append(max((x["count"] for x in classes.groupBy("root").count().collect()), default=0)), tiles(classes, *a))[1])
    assert result(shingle_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))) == brute_components(rows)
    assert max(crowds) < 20


@pytest.mark.parametrize("pairs", [1, 250_000])
def test_a_bucket_joins_what_admitted_pairs_join(monkeypatch, pairs):
    monkeypatch.setattr(shingle_join, "PAIRS", pairs)
    monkeypatch.setattr(shingle_join, "NEXT", 1)
    rng = np.random.default_rng(3)
    rows = 160
    token, vertex, size = rng.integers(0, 6, rows).astype(np.uint64), rng.integers(0, 90, rows), None
    of = rng.integers(20, 60, 90)
    size, place = of[vertex].astype(np.int32), rng.integers(0, 9, rows).astype(np.int32)
    base = rng.integers(0, 2**63, (3, 2)).astype(np.uint64)
    sketch = (base[rng.integers(0, 3, 90)] ^ (np.uint64(1) << rng.integers(0, 63, (90, 2)).astype(np.uint64)))[vertex]
    parent = list(range(90))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(rows):
        for j in range(rows):
            a, b = sorted((int(size[i]), int(size[j])))
            need = -(-80 * (a + b) // 180)
            differ = sum(bin(int(p) ^ int(q)).count("1") for p, q in zip(sketch[i], sketch[j]))
            if token[i] == token[j] and b <= a * 100 // 80 and place[i] <= size[i] - need and place[j] <= size[j] - need and (a + b - differ) // 2 >= need:
                parent[find(vertex[i])] = find(vertex[j])
    edges = shingle_join._connect(token, vertex, size, place, sketch, 80)
    got = dict(zip(*map(np.ndarray.tolist, edges.T)))
    want = {int(v) for v in vertex}
    assert len({find(v) for v in want}) == len(want) - len(got)
    assert got and all(find(a) == find(b) for a, b in got.items())


def test_bitmap_bound_admits_every_pair():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 700, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 400, 60)]
    sets.sort(key=len)
    bits = shingle_join.Signatures([shingle_join.signature(s) for s in sets])
    for i, a in enumerate(sets):
        j = np.array([j for j in range(i + 1, len(sets)) if len(sets[j]) <= 1.25 * len(a)], np.int64)
        for other, differ in zip(j, bits.differing(i, j)):
            assert len(np.intersect1d(a, sets[other])) <= (len(a) + len(sets[other]) - differ) // 2


def test_drop_near_duplicates_keeps_one_of_each_group(hard):
    left = shingle_join.drop_near_duplicates(hard)
    assert left.columns == hard.columns
    groups = brute_components([(r["doc_id"], r["text"]) for r in hard.collect()])
    want = {c for d, n, c in groups if n} | {d for d, n, c in groups if not n}
    assert {r["doc_id"] for r in left.collect()} == want
    assert left.where("text like '%quick%'").count() == len({c for d, n, c in brute_components([(r["doc_id"], r["text"]) for r in hard.where("lower(text) like '%quick%'").collect()])})


def test_tiles_of_long_sets_are_cut_and_copies_counted_once(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "TILE_SHINGLES", 400)
    r = random.Random(6)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:-1 - i % 5] + [f"e{r.randrange(9)}"])) for i in range(40)] + [(100 + i, "a b c d e f") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = shingle_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter((x[0], x[2]) for x in got) == Counter((d, c) for d, n, c in brute_components(rows))
    classes = spark.createDataFrame([(i, i, 7, 100, 1) for i in range(40)], "cls bigint, least_id bigint, root bigint, n_shingles bigint, copies bigint")
    held = shingle_join._tiles(classes, 80, shingle_join.TILE).groupBy("root", "tile_band", "tile_a", "tile_b").count().collect()
    assert max(h["count"] for h in held) < 40                           # by their number the sets fit one tile
    packed = spark.createDataFrame([("a b c d e f",)] * 30, "text string").coalesce(1).mapInArrow(shingle_join._tokens(80, 2), "bucket int, tokens binary").collect()
    tokens = Counter(t for row in packed for t in np.frombuffer(row["tokens"], np.uint64).tolist())
    assert tokens and set(tokens.values()) == {shingle_join.FREQUENT}


def test_drop_near_duplicates_keeps_one_of_rows_that_tie(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")
    rows = [(1, x), (1, x), (None, y), (None, y.upper()), (None, f" {y} "), (None, ""), (None, " "), (None, None), (2, z), (2, z + " end"), (2, "")]
    left = shingle_join.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert Counter((r["doc_id"], (r["text"] or "").strip().lower()[:1]) for r in left) == {(1, "x"): 1, (None, "y"): 1, (None, ""): 3, (2, "z"): 1, (2, ""): 1}


@pytest.mark.parametrize("forest", [3, 1_000_000])
def test_components(spark, monkeypatch, forest):
    monkeypatch.setattr(components_module, "FOREST", forest)
    r = random.Random(forest)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(-5, -9), (7, 7)]
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    joined = {v for a, b in edges if a != b for v in (a, b)}
    got = components_module.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)).collect()
    assert sorted((x["vertex"], x["root"]) for x in got) == sorted((v, find(v)) for v in joined)


def brute_repeats(rows, window=50):
    first = {}
    order = lambda d: (d is None, d or 0)
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - window + 1):
            g = raw[p:p + window]
            if g not in first or order(doc) < order(first[g]):
                first[g] = doc
    out = Counter()
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - window + 1):
            if order(first[raw[p:p + window]]) < order(doc):
                gone[p:p + window] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(raw) else 0
        out[(doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_repeats_of_hard_rows(hard, empty):
    assert Counter(map(tuple, repeats.remove_repeats(hard).collect())) == brute_repeats([(r["doc_id"], r["text"]) for r in hard.collect()])
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_of_cut_and_shifted_passages(spark):
    r = random.Random(4)
    passages = ["".join(r.choices("abcdefgh \n", k=r.choice([49, 50, 51, 60, 75, 130, 400]))) for _ in range(25)] + ["z" * 120, "xy" * 80]
    rows = []
    for i in range(120):
        parts = ["".join(r.choices("ijklmnop é", k=r.randint(0, 60)))]
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            a = r.choice([0, 0, r.randint(0, 20)])
            parts += [p[a:len(p) - r.choice([0, 0, r.randint(0, 20)])], "".join(r.choices("ijklmnop é", k=r.randint(0, 9)))]
        rows.append((r.choice([i, i, i, 7]), "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert Counter(map(tuple, repeats.remove_repeats(docs).collect())) == brute_repeats(rows)


@pytest.mark.parametrize("bound", [0, 8])
def test_repeats_of_passages_that_all_documents_share(spark, monkeypatch, bound):
    monkeypatch.setattr(repeats, "HOT", bound)
    r = random.Random(5)
    line, passage = ("".join(r.choices("abcdefgh \n", k=k)) for k in (40, 130))
    own = lambda: "".join(r.choices("ijklmnop é", k=40))
    rows = [(r.choice([i, i, i, 7, None]), own() + r.choice([line, line * 3, passage, passage[9:], line + passage]) + own() + line + own()) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert Counter(map(tuple, repeats.remove_repeats(docs).collect())) == brute_repeats(rows)
    # no representative keeps a string of each document: what is left is bounded, not by the documents
    sent = docs.mapInArrow(repeats._strings(4, repeats._screens(docs, 4)), repeats._STRINGS).collect()
    strings = {(k, t) for row in sent for k, t, size in zip(*(np.frombuffer(row[c], d).tolist() for c, d in (("k", np.int64), ("t", np.int32), ("size", np.int32)))) if size}
    assert max(Counter(t for _, t in strings).values(), default=0) <= 2 * bound


def test_merged_transforms_sort_like_one(monkeypatch):
    r = random.Random(9)
    base = "".join(r.choices("abcd", k=300))
    strings = sorted({base[a:a + r.randint(50, 90)].encode() for a in range(0, 200, 3)})
    size = np.array([len(s) for s in strings], np.int64)
    body = np.frombuffer(b"".join(strings), np.uint8)
    for shard in (1, 200, 1 << 18):
        monkeypatch.setattr(repeats, "SHARD", shard)
        owner = np.array(r.sample(range(1000), len(strings)), np.int64)
        got = repeats.smallest_owner(body, size, owner)
        least = {}
        for s, o in zip(strings, owner):
            for p in range(len(s) - 49):
                least[s[p:p + 50]] = min(o, least.get(s[p:p + 50], o))
        assert got.tolist() == [least[s[p:p + 50]] for s in strings for p in range(len(s) - 49)]


def brute_verdict(url, rules, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match("[^/?#]*", rest).group())
    path = re.match("[^?#]*", rest[len(host):]).group()
    fits = [(-len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    canonical = re.sub(":(80|443)$", "", host.removeprefix("www.")) + path.rstrip("/")
    best = min(fits, default=None)
    return host, path, best and best[1], best[2] if best else "block" if canonical in listed else "allow"


@pytest.mark.parametrize("blocks", [1, 1 << 15])
def test_urls(spark, blocks):
    hosts = ["a.net", "EXAMPLE.net", "x.example.net", "notexample.net", "example.com", "www.example.com", "org", "b.org:443", "listed.io", "www.listed.io:80", "", "a..net", "net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/1", "/fr/2/", "/fr/2//", "/a/b?x=/en/", "#/en/", "/en/\n"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "x://y://z/en/", "http://a.net/", "http://a.net/"]
    rules = [*url_filter.RULES, ("block", "listed.io", ""), ("allow", "listed.io", "/fr/")]
    listed = ["b.org/fr/2", "b.org", "example.com/a/b", "a..net", "notexample.net", None]
    pages = spark.createDataFrame([(i if i % 9 else None, u, "extra") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    got = url_filter.filter_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string"), spark.createDataFrame([(x,) for x in listed], "canonical string"), blocks)
    want = Counter((i if i % 9 else None, *brute_verdict(u, rules, listed)) for i, u in enumerate(urls))
    assert Counter(map(tuple, got.collect())) == want
    none = url_filter.filter_urls(pages.limit(0), spark.createDataFrame([], "verdict string, host string, path string"), spark.createDataFrame([], "canonical string"))
    assert none.count() == 0


def test_url_filter_stays_in_the_jvm(spark):
    from voxtide.llm.queries import op3_url_filter
    plan = op3_url_filter(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_against_brute_force(spark):
    import sentencepiece
    from voxtide.llm import mixing, quality
    from voxtide.llm.queries import piece_model

    docs = read(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near duplicates", "source mix", "piece coding"]
    kept = {r["doc_id"] for r in quality.judge(docs, quality.fit(docs, read(spark, SF, "labels"))).where("kept").collect()}
    rows = sorted((r["doc_id"], r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in kept)
    once = {}
    for r in rows:
        once.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r[1]), r)
    rows = sorted(once.values())
    heads = {c for _, _, c in brute_components([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] in heads]
    mix = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixture(materialize(docs.where(docs["doc_id"].isin([r[0] for r in rows])), "test")).collect()}
    coder = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = Counter()
    for doc, text, _ in rows:
        want[(doc, tuple(coder.encode(text, add_bos=True, add_eos=True)))] += mix[doc]
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == +want
    assert Counter(hash(r["decoded"]) for r in got.collect()) == Counter(hash(t) for d, t, _ in rows for _ in range(mix[d]))


def test_stages_take_hard_rows(spark, hard):
    docs = hard
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "test")
        assert name == "piece coding" or out.columns == hard.columns
        stage(spark, docs.limit(0), SF).count()
        docs = out
