"""Operators 11, 12 and 13 on hard cases, against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from voxtide.llm import fingerprints, manifest, spelling


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def seen(values):
    return sorted(values, key=str)


# ------------------------------------------------------------------ 11
def brute_tree(text):
    """The root, from lines and phrases cut word by word."""
    raw, hashes = text.encode(), []
    for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw):
        import numpy as np
        h = fingerprints.segment_hash(np.frombuffer(m.group(), np.uint8), np.array([0]), np.array([len(m.group())]))[0]
        before = hashes[-1][1] if hashes else np.uint64(0)
        with np.errstate(over="ignore"):
            cut = fingerprints.mix(np.array([h + before * np.uint64(3)]))[0] % np.uint64(fingerprints.PHRASE) == 0
        hashes.append((m.end() if cut else None, h))
    lines = {i + 1 for i, b in enumerate(raw) if b == 10} | {len(raw)}
    ends = sorted(({e for e, _ in hashes if e} | lines) - {0})
    node = lambda kind, parts: hashlib.sha256(kind + b"".join(parts)).digest()
    sections, paragraphs, phrases, start = [], [], [], 0
    for e in ends:
        phrases.append(hashlib.sha256(b"\0" + raw[start:e]).digest())
        start = e
        if e in lines:
            paragraphs.append(node(b"\1", phrases))
            phrases = []
            if paragraphs[-1][-1] % fingerprints.SECTION == 0 or e == len(raw):
                sections.append(node(b"\2", paragraphs))
                paragraphs = []
    return node(b"\3", sections).hex()


def test_fingerprints_of_rows(hard):
    rows = hard.collect()
    got = fingerprints.compared(hard).collect()
    assert len(got) == len(rows)
    roots = {t: brute_tree(t) for t in {r["text"] or "" for r in rows}}
    prints = {t: fingerprints.fingerprints([t])[0] for t in roots}
    assert all(prints[t][:64] == root for t, root in roots.items()) and len(set(roots.values())) == len(roots)
    assert seen((r["doc_id"], r["n_chars"], r["fingerprint"]) for r in got) == seen((r["doc_id"], len(r["text"] or ""), prints[r["text"] or ""]) for r in rows)
    ids = [r["doc_id"] for r in rows]
    texts = defaultdict(set)
    for r in rows:
        texts[r["doc_id"]].add(r["text"] or "")
    order = sorted({i for i in ids if i is not None})
    for r in got:
        if r["doc_id"] is None or ids.count(r["doc_id"]) > 1:
            continue
        (text,) = texts[r["doc_id"]]
        place = order.index(r["doc_id"])
        nexts = texts[order[place + 1]] if place + 1 < len(order) else texts[None]
        fits = [f for f in nexts if sha(fingerprints.edited(text, f)) == r["edited_sha256"]
                and fingerprints.fingerprints([fingerprints.edited(text, f)])[0] == r["edited_fingerprint"]
                and r["near_next"] == fingerprints.likeness(prints[text], fingerprints.fingerprints([f])[0])]
        assert fits and 0 <= r["near_edited"] <= 1
        assert r["near_edited"] == fingerprints.likeness(r["fingerprint"], r["edited_fingerprint"])
    assert seen(map(str, got)) == seen(map(str, fingerprints.compared(hard.repartition(7)).collect())) or any(ids.count(i) > 1 for i in ids)


def test_next_document_over_stretches(spark):
    rows = [(i * 3, f"text {i} " + "word " * (i % 40) + chr(200 + i % 50)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {r["doc_id"]: r for r in fingerprints.compared(docs).collect()}
    assert len(got) == 500
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % 500][1]
        half = len(text) // 2
        want = text[:len(text) - half] + following[:half]
        assert got[i]["edited_sha256"] == sha(want) and got[i]["edited_fingerprint"] == fingerprints.fingerprints([want])[0]
        assert got[i]["near_next"] == fingerprints.likeness(*fingerprints.fingerprints([text, following]))


def test_differences_locate_an_edit():
    text = "\n".join(" ".join(f"word{(i * 37 + k * 11) % 501}" for k in range(30)) for i in range(40))
    spot = text.index("\n", 3000) + 40
    changed = text[:spot] + "CHANGED" + text[spot + 3:]
    a, b = fingerprints.fingerprints([text, changed])
    spans = fingerprints.differences(a, b)
    assert spans and all(s <= spot + 400 and e >= spot - 400 for s, e in spans) and any(s <= spot < e for s, e in spans)
    assert fingerprints.differences(a, a) == [] and fingerprints.likeness(a, a) == 1 and 0.9 < fingerprints.likeness(a, b) < 1
    moved = fingerprints.fingerprints(["a new first line\n" + text])[0]
    assert fingerprints.likeness(a, moved) > 0.95            # an insertion moves no cut elsewhere
    assert fingerprints.likeness(*fingerprints.fingerprints(["", ""])) == 1 and fingerprints.likeness(*fingerprints.fingerprints(["", "x"])) == 0


def test_one_document_and_none(spark, empty):
    one = spark.createDataFrame([(5, "héllo wörld")], "doc_id long, text string")
    (r,) = fingerprints.compared(one).collect()
    assert (r["n_chars"], r["near_next"], r["edited_sha256"]) == (11, 1.0, sha("héllo " + "héllo"))
    assert fingerprints.compared(empty).count() == 0


# ------------------------------------------------------------------ 12
RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows):
    n = Counter()
    for r in rows:
        for run in RUN.findall(r["text"] or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def variants(docs):
    return sorted((tuple(r) for r in spelling.group_variants(docs, spelling.damage).collect()), key=str)


def test_spelling_on_hard_rows(hard):
    assert variants(hard) == brute_variants(brute_words(hard.collect()))


def test_spelling_of_many_near_words(spark):
    letters = "abé÷"
    words = ["".join(w) for w in itertools.product(letters, repeat=5)] + ["".join(w) for w in itertools.product("ab", repeat=6)] + ["é" * 90, "é" * 89, "Ä" * 91]
    rows = [(i if i % 11 else None, " ".join(w.upper() if k % 2 and w.isascii() else w for k in range(3 + (i % 17) ** 2))) for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert variants(docs) == brute_variants(brute_words([{"doc_id": i, "text": t} for i, t in rows]))


def test_popular_chunks_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HOT", 3)
    words = ["prefix" + "".join(w) for w in itertools.product("xyz", repeat=4)]
    docs = spark.createDataFrame([(i, f"{w} {w} {w}") for i, w in enumerate(words)], "doc_id long, text string")
    n = {w: c for w, c in brute_words([{"doc_id": i, "text": f"{w} {w} {w}"} for i, w in enumerate(words)]).items()}
    assert variants(docs) == brute_variants(n)


def test_no_words(empty, spark):
    assert spelling.group_variants(empty).count() == 0
    assert spelling.group_variants(spark.createDataFrame([(1, None), (2, "12 34"), (None, "")], "doc_id long, text string")).count() == 0


# ------------------------------------------------------------------ 13
def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_leaf(r, more=0):
    n = r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more
    return sha("".join(map(framed, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))


def brute_tree_of(leaves, arity):
    """Root, and per leaf its levels of (slot, siblings)."""
    steps = [[] for _ in leaves]
    nodes = [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        up = []
        for k in range(0, len(nodes), arity):
            run = nodes[k:k + arity]
            for slot, (_, members) in enumerate(run):
                for m in members:
                    steps[m].append((slot, [d for j, (d, _) in enumerate(run) if j != slot]))
            up.append((sha("".join(d for d, _ in run)), [m for _, members in run for m in members]))
        nodes = up
    return nodes[0][0], steps


def brute_manifest(rows, arity):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
        trees[g] = brute_tree_of([brute_leaf(r) for r in groups[g]], arity)
    root, above = brute_tree_of([trees[g][0] for g in order], arity)
    out = []
    for g, up in zip(order, above):
        for r, steps in zip(groups[g], trees[g][1]):
            path = steps + up
            d = brute_leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0)
            for slot, others in path:
                d = sha("".join([*others[:slot], d, *others[slot:]]))
            out.append((r["doc_id"], brute_leaf(r), trees[g][0], root, sha("".join(x for _, o in path for x in o)), d, d == root))
    return sorted(out, key=str)


def checked(docs, arity):
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0, manifest.leaf_of(n_chars=F.col("n_chars") + 1))
    rows = manifest.manifest(docs, arity, tampered=changed).withColumn("folded", manifest.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("path")), "folded", F.col("folded") == F.col("root")).collect()), key=str)


def test_manifest_on_hard_rows(hard):
    rows = hard.collect()
    for arity in (2, 3):
        assert checked(hard, arity) == brute_manifest(rows, arity)


def test_manifest_of_uneven_groups(spark):
    rows = [(i, f"s{i % 3}", ["en", "en", "de", None, "é"][i % 5] if i != 44 else "zz", i if i % 4 else None, f"text {i}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    want = brute_manifest([dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows], 2)
    assert checked(docs, 2) == want
    assert any(not w[-1] for w in want) and any(w[-1] for w in want)        # tampering is found, the rest verifies


def test_manifest_of_one_row_and_none(spark, empty):
    one = spark.createDataFrame([(1, "s", None, 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    (r,) = manifest.manifest(one).collect()
    assert r["leaf"] == r["subroot"] == r["root"] and r["path"] == []
    assert manifest.manifest(empty).count() == 0
