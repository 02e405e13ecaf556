"""Spelling variants, mixing and centroid clustering against plain versions, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from compare import connect, difference
from wardgrid.llm import centroids, mixing, spelling
from wardgrid.llm.queries import ORACLES, QUERIES
from wardgrid.llm.workers import importable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(session, name):
    assert difference(QUERIES[name](session, SF), connect(SF), ORACLES[name]) is None


# ---------------------------------------------------------------- spelling
def plain_words(rows, slip=spelling.SLIP):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if slip and h % slip == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, factor=5):
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def made_words(seed, alphabet, shortest, number):
    """Words, many of them one to three edits from another, some of one repeated letter."""
    rng = random.Random(seed)
    counts = {alphabet[0] * n: rng.randint(1, 900) for n in range(shortest, shortest + 6)}
    while len(counts) < number:
        word = rng.choice(sorted(counts)) if rng.random() < 0.7 else "".join(rng.choices(alphabet, k=rng.randint(shortest, 11)))
        for _ in range(rng.randint(1, 3)):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            word = word[:at] + ("" if kind == 0 else rng.choice(alphabet)) + word[at + (kind != 1) :]
        if len(word) >= shortest:
            counts[word] = int(5 ** rng.uniform(0, 6))
    return counts


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize(
    ("alphabet", "shortest", "crowd", "very_long"),
    [("abcdéß", 6, 1024, 4096), ("ab", 6, 3, 4096), ("ab", 6, 30, 9), ("abÿ", 1, 2, 4096), ("abcdefgh", 6, 0, 4096), ("abc", 5, 12, 4096)],
)
def test_variants_equal_all_pairs(session, alphabet, shortest, crowd, very_long):
    counts = made_words(len(alphabet) + crowd, alphabet, shortest, 350)
    words = session.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(words, crowd=crowd, very_long=very_long)) == plain_variants(counts)


def test_bound_of_affected_grams_holds():
    counts = made_words(5, "abc", 2, 300)
    grams = collections.Counter()
    for w in counts:
        grams.update(f"^{w}$"[p : p + q] for q in range(2, 6) for p in range(len(w) + 3 - q))
    frequent = {g: n for g, n in grams.items() if n > 8}
    found = {w: spelling.tokens(w, frequent) for w in counts}
    for a, (one, bound) in found.items():
        assert len(one) == len(set(one)) == len(a) + 1 and bound <= spelling.LONGEST
        for b, (two, _) in found.items():
            if a != b and one_edit(a, b):
                assert len(set(one) & set(two)) >= len(one) - bound


def test_words_of_odd_texts(session):
    long = "x" * 20_000
    rows = [(None, None), (1, ""), (2, "1 2 ..."), (3, "Straße STRASSE straße× " * 6), (None, "Straßen " * 5), (None, "Straßen " * 5)]
    rows += [(4, (long + " ") * 6 + (long + "y ") * 40), (5, "abcdef-ghijkl_" * 7), (5, "abcdef-ghijkl_" * 7)] + [(i, "wörter wörtre") for i in range(60)]
    docs = session.createDataFrame([(i, t, "w", 1, "r") for i, t in rows], "doc_id long, text string, word string, n int, root string")
    want = plain_words(rows)
    words = spelling.counted(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == want
    assert rows_of(spelling.variants(words)) == plain_variants(want)
    assert spelling.variants(spelling.counted(docs.limit(0))).collect() == []


def test_words_of_all_documents(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    want = plain_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(QUERIES["op11_gram_spelling"](session, SF)) == plain_variants(want)


# ---------------------------------------------------------------- mixing
def plain_targets(sizes, weights, share, epochs):
    """Targets by the definition: clamp, give the excess to the others, again."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    wanted, clamped = share * sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in clamped)
        left = wanted - sum(epochs * sizes[s] for s in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * w / free for s, w in weight.items()}
        above = {s for s in target if target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


def check_mix(mixed, rows, weights=(5, 2, 1), share=1.5, epochs=2):
    found = [r.asDict() for r in mixed.collect()]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((repr(r["doc_id"]), r["size"]) for r in found) == sorted((repr(r[0]), size(r[1])) for r in rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += size(r[1])
    want = plain_targets(sizes, weights, share, epochs)
    for s in sizes:
        mine = [r for r in found if r["source"] == s]
        assert all(math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9) and r["source_size"] == sizes[s] for r in mine)
        taken = [r["whole"] * r["size"] + r["part"] for r in mine]
        assert all(0 <= t <= epochs * r["size"] for t, r in zip(taken, mine, strict=True))
        equal = max(collections.Counter(r["size"] for r in mine).values())
        assert want[s] - equal - 1 <= sum(taken) <= want[s] + 1e-6
        cut = collections.Counter(r["part"] for r in mine if 0 < r["part"] < r["size"])
        assert len(cut) <= 1  # one document, or rows equal to it, is taken in part
    return sorted((repr(r["doc_id"]), r["size"], r["whole"], r["part"]) for r in found)


def test_mix_of_odd_rows(session):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["b", "a", "é", "￮", "\U0001f600", "", None])) for i in range(400)]
    rows += [(None, "one two three", "b")] * 300 + [(7, None, "a"), (8, "", None), (9, "\t\n", "only blanks"), (10, "z y x\x1f", "one"), (11, "long " * 50_000, "b")]
    schema = "doc_id long, text string, source string, size string, target int, part int, draw int, `of` int"
    docs = session.createDataFrame([(*r, "s", 1, 2, 3, 4) for r in rows], schema)
    first = check_mix(mixing.mix(docs), rows)
    assert first == check_mix(mixing.mix(docs.repartition(13)), rows)
    check_mix(mixing.mix(docs, weights=(1, 9), share=0.4, epochs=3, seed=9), rows, (1, 9), 0.4, 3)
    assert first != check_mix(mixing.mix(docs, seed=2), rows)
    assert mixing.mix(docs.limit(0)).collect() == []
    empty = mixing.mix(docs.where("text is null or text = ''")).collect()
    assert {(r["size"], r["target"], r["whole"], r["part"]) for r in empty} == {(0, 0.0, 0, 0)}


def test_copies_hold_the_words_taken(session):
    docs = session.createDataFrame([(i, f" a{i}  b{i}\tc{i} \n d{i}", f"s{i % 4}") for i in range(41)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, carry=("text",))
    want = {r["doc_id"]: r["whole"] * 4 + r["part"] for r in mixed.collect()}
    got = collections.Counter()
    for r in mixing.copies(mixed).collect():
        words = r["text"].split()
        assert words == [f"{c}{r['doc_id']}" for c in "abcd"][: len(words)] and words
        got[r["doc_id"]] += len(words)
    assert {i: n for i, n in want.items() if n} == dict(got) and any(n % 4 for n in got.values())


# ---------------------------------------------------------------- centroids
def plain_clusters(rows, k, rounds, dimensions, seed=1):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    draw = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=draw)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(x) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(cents)]
    return sorted(((repr(i), nearest(v)[1], nearest(v)[0]) for i, v in kept)), cents


@pytest.mark.parametrize(("k", "dimensions", "spread"), [(16, 5, 3.0), (7, 3, 0.05), (16, 2, 0.03), (1, 4, 1.0), (40, 3, 1.0)])
def test_clusters_equal_a_plain_search(session, k, dimensions, spread):
    """Small spreads give many equal components, so equally near centroids, empty ones and equal vectors."""
    rng = random.Random(k)
    rows = [(i, [rng.gauss(0, spread) for _ in range(dimensions)]) for i in range(300)]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[6][1]), (900, None), (901, []), (902, [1.0]), (903, [None] * dimensions)]
    rows += [(904, [float("nan")] * dimensions), (905, [float("inf")] * dimensions), (906, [1.0] * (dimensions + 1)), (907, [-0.0] * dimensions)]
    schema = "vec_id long, embedding array<double>, id string, vector int, cluster int, distance long"
    table = session.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], schema)
    assigned, found = centroids.cluster(table, k=k, dimensions=dimensions)
    want, cents = plain_clusters(rows, k, 3, dimensions)
    assert sorted((repr(r["id"]), r["cluster"], r["distance"]) for r in assigned.collect()) == want
    found = sorted(found.collect())
    assert [r["components"] for r in found] == cents
    per = collections.Counter()
    for _, c, d in want:
        per[c] += d
    assert [(r["cluster_inertia"], r["inertia"]) for r in found] == [(per[j], sum(per.values())) for j in range(len(cents))]


def test_search_equals_all_distances_and_compares_fewer():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(-50, 50, (60, 8)), rng.integers(-50, 50, (4, 8)).repeat(2, axis=0)])
    points = np.concatenate([rng.integers(-60, 60, (5000, 8)), values, np.zeros((3, 8), int)])
    number, distance = centroids.Centroids(values).nearest(points)
    apart = ((points[:, None] - values[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_few_no_and_huge_vectors(session):
    rows = [(1, [1e300, -1e300]), (2, [0.0, 0.0]), (2, [0.0, 0.0])]
    table = session.createDataFrame(rows, "vec_id long, embedding array<double>")
    assigned, found = centroids.cluster(table, dimensions=2)
    assert sorted((r["id"], r["distance"]) for r in assigned.collect()) == [(1, 0), (2, 0), (2, 0)]
    assert sorted(r["n"] for r in found.collect()) == [0, 1, 2]
    for empty in (table.limit(0), table.where("vec_id is null")):
        assigned, found = centroids.cluster(empty, dimensions=2)
        assert assigned.collect() == [] and found.collect() == []
