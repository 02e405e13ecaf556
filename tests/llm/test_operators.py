"""Each operator against a brute-force version, a round trip or held-out labels, and on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardgrid.llm import arrow_ids, decontaminate, html_blocks, html_extract, hyperminhash, language, packing
from wardgrid.llm import quality, simhash, suffix_dedup, suffix_sort, tokens, window_dedup
from wardgrid.llm.workers import importable

SF = "/root/testdata/sf0.001"
ODD = [(None, None), (None, "a " * 300), (5, "x" * 1000), (5, "x" * 1000), (6, ""), (7, "b c " * 100), (8, "é " * 150), (9, "zz" + "é " * 150), (10, "A B"), (11, "\t\n ")]
COLUMNS = "doc_id long, text string, spans string, part string, score string, kept string, lang string"


@pytest.fixture(scope="module")
def session(spark):
    return importable(spark)


@pytest.fixture(scope="module")
def docs(session):
    return session.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(session):
    return session.createDataFrame([(*r, "x", "y", "z", "k", "en") for r in ODD], COLUMNS)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def covered(items, length, counts):
    gone = np.zeros(len(items), bool)
    for s in range(len(items) - length + 1):
        if counts[items[s : s + length]] > 1:
            gone[s : s + length] = True
    return gone


def windows(rows, length):
    return collections.Counter(r[s : s + length] for r in rows for s in range(len(r) - length + 1))


def by_bytes(rows, length=200):
    rows = [(i, (t or "").encode()) for i, t in rows]
    counts, out = windows([b for _, b in rows], length), []
    for i, b in rows:
        gone = covered(b, length, counts)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def by_words(rows, length=35):
    rows = [(i, tuple((t or "").encode().split())) for i, t in rows]
    counts, out = windows([w for _, w in rows], length), []
    for i, w in rows:
        gone = covered(w, length, counts)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def components(rows, k=4):
    sets = []
    for i, t in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 80 * (len(sets[a][1]) + len(sets[b][1]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[root(n)] = min(least.get(root(n), i), i)
    return sorted(((i, len(s), least[root(n)], i == least[root(n)]) for n, (i, s) in enumerate(sets)), key=repr)


def test_two_stage_order():
    rng = np.random.default_rng(1)
    for _ in range(100):
        data = np.append(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 60)), 255).astype(np.uint8)
        order, words = suffix_sort.suffix_order(data, 200)
        raw = data.tobytes()
        assert list(order) == sorted(range(len(raw)), key=lambda i: raw[i:])
        if len(raw) > 4:
            same = suffix_sort.adjacent_prefixes(words, order, 3)
            assert [raw[a : a + 3].ljust(3, b"\xff") == raw[b : b + 3].ljust(3, b"\xff") for a, b in zip(order, order[1:], strict=False)] == list(same[1:])


def test_suffix_dedup(docs, odd, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert plain(suffix_dedup.suffix_dedup(docs)) == by_bytes(rows)
    assert plain(suffix_dedup.suffix_dedup(odd)) == by_bytes(ODD)
    monkeypatch.setattr(suffix_dedup, "CROWD", 1)
    assert plain(suffix_dedup.suffix_dedup(docs)) == by_bytes(rows)


def test_window_dedup(docs, odd):
    assert plain(window_dedup.window_dedup(docs)) == by_words([(r.doc_id, r.text) for r in docs.collect()])
    assert plain(window_dedup.window_dedup(odd)) == by_words(ODD)
    assert {"doc_id", "text", "spans", "kept", "n_removed"} <= set(window_dedup.window_dedup(odd, with_text=True).columns)
    assert plain(window_dedup.window_dedup(odd.limit(0))) == []


def test_near_duplicates(docs, odd):
    assert plain(hyperminhash.near_duplicates(docs).drop("chosen")) == components([(r.doc_id, r.text) for r in docs.collect()])
    found = {r.doc_id: r for r in hyperminhash.near_duplicates(odd.where("doc_id is not null")).collect()}
    assert not found[9].component_id == 8 and found[6].n_shingles == 0 and found[6].kept


def test_near_duplicates_in_blocks(session, monkeypatch):
    """A family of loosely related texts, large groups forced into blocks of two."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(n, " ".join(w if rng.random() > 0.03 else f"x{rng.random()}" for w in base)) for n in range(40)]
    monkeypatch.setattr(hyperminhash, "FEW_PAIRS", 0)
    monkeypatch.setattr(hyperminhash, "BLOCK", 2)
    assert plain(hyperminhash.near_duplicates(session.createDataFrame(rows, "doc_id long, text string")).drop("chosen")) == components(rows)


def test_packing(session, docs, odd):
    tokenizer = tokens._tokenizer(tokens.default_path())
    extra = session.createDataFrame([(10**6, "A  b c<|endoftext|>x ́e Σας İ it's \x1c y 12 34"), (10**6 + 1, "lorem ipsum " * 6000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    places = collections.defaultdict(list)
    texts = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in rows.collect()}
    for r in packing.pack(rows, with_ids=True).collect():
        own = np.array(texts[r.doc_id][r.start : r.start + 4096], "<u4").tobytes()
        assert bytes(r.ids) == own and r.ids_crc32 == zlib.crc32(own) and r.length == len(own) // 4 and r.start == 4096 * r.piece
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        assert all(a == sum(n for _, n in sorted(own)[:k]) for k, (a, _) in enumerate(sorted(own))) and sum(n for _, n in own) <= 4096
    total = sum(map(len, texts.values()))
    assert sum(n for own in places.values() for _, n in own) == total and len(places) <= -(-total // 4096) + 2
    assert packing.pack(odd).count() == len(ODD) and packing.pack(odd.limit(0)).count() == 0


def test_dominance_keeps_the_optimum():
    def optimum(items, room):
        if not items:
            return 0
        first, rest = items[0], items[1:]
        best = len(items)
        for mask in range(1 << len(rest)):
            chosen = [x for k, x in enumerate(rest) if mask >> k & 1]
            if first + sum(chosen) <= room:
                best = min(best, 1 + optimum([x for k, x in enumerate(rest) if not mask >> k & 1], room))
        return best

    rng = random.Random(2)
    for _ in range(60):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        fixed, left = packing.reduced(dict(collections.Counter(items)), 12)
        remaining = sorted((k for k, n in left.items() for _ in range(n)), reverse=True)
        assert sum(n for n, _ in fixed) + optimum(remaining, 12) == optimum(items, 12), items


def test_arrow_ids(docs, odd, tmp_path):
    tokenizer, start = tokens._tokenizer(tokens.default_path()), 0
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = sorted(tuple(r) for r in arrow_ids.arrow_ids(docs, length=64, folder=str(tmp_path / "ids")).collect())
    for (doc_id, text), got in zip(rows, found, strict=True):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert arrow_ids.arrow_ids(odd).count() == len(ODD) and arrow_ids.arrow_ids(odd.limit(0)).count() == 0


def test_simhash(docs, odd):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    found = {r.doc_id: r for r in simhash.edited_fingerprints(docs, blocks=5).collect()}
    for i, text in texts.items():
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[following[i]][:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and found[i].n_chars == len(text)
    assert np.mean([r.near_edited > r.near_next for r in found.values()]) > 0.95
    prints = sorted({r.fingerprint for r in found.values()})
    near = {(a, b) for a in prints for b in prints if a < b and (int(a, 16) ^ int(b, 16)).bit_count() <= 3}
    assert {(r.a, r.b) for r in simhash.within_radius(docs.sparkSession.createDataFrame([(p,) for p in prints], "fingerprint string")).collect()} == near
    assert simhash.edited_fingerprints(odd).count() == len(ODD) and simhash.edited_fingerprints(odd.limit(0)).count() == 0


def test_language(session, odd):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = language.identify(docs, learn="crc32(cast(doc_id as string)) % 4 <> 2").where("crc32(cast(doc_id as string)) % 4 = 2").collect()
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in found]) > 0.97
    got = language.identify(odd)
    assert {r.lang_pred for r in got.where("doc_id in (6, 11)").collect()} == {"und"} and got.count() == len(ODD)


def test_quality(session, odd):
    docs, labels = (session.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = quality.score(docs, labels, quality.LEARN).where("crc32(cast(doc_id as string)) % 5 = 0").collect()
    assert np.mean([truth[r.doc_id] == r.predicted for r in held if r.doc_id in truth]) > 0.93
    assert quality.score(odd, labels.limit(0)).where("score = 1").count() == len(ODD)


def test_html(session):
    page = "<body><nav><li><a href=1>Home</a></nav><article><h1>T &amp; x</h1><p>a <i>b</i>\n c<p>d<script>var t='</p>';</script> e</article><div class=ad>Buy</div>"
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<p>" + "x " * 50_000), (1, "u", page)]
    found = html_extract.extract(session.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r.text for r in found if r.page_id == 1] == ["T & x\na b c\nd e"] * 2
    assert [(r.text, r.n_chars) for r in found if r.page_id in (2, 3)] == [("", 0)] * 2
    assert [b.text for b in html_blocks.blocks("a<br>b<p>c<!-- x -->d &lt;")] == ["a b", "cd <"]
    rng, right = random.Random(99), []
    for _ in range(60):
        blocks, label = html_extract.labelled(rng)
        x, mask = html_extract._together([html_extract.vectors(blocks)])
        right += list((html_extract.trained().forward(x, mask)[0][:, 0] >= 0.5) == (label > 0))
    assert np.mean(right) > 0.98


def test_decontamination(session, odd):
    docs, items = (session.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    item = [r.text for r in items.orderBy("item_id").collect()]
    substituted = " ".join(w if k % 5 else "zzz" for k, w in enumerate(item[1].split()))
    rows = session.createDataFrame([(1, item[0]), (2, "begin " + substituted), (3, None), (4, "x y z u v w a b"), (5, item[2][:30])], "doc_id long, text string")
    short = session.createDataFrame([(900, "z u v w a"), (901, None), (902, "z")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated_documents(rows, items.select("item_id", "text").union(short)).collect()}
    assert found == {(1, 0), (2, 1), (4, 900)}
    assert decontaminate.contaminated_documents(odd, items).count() == 0
    assert decontaminate.clean(odd, items.limit(0)).count() == len(ODD)


def test_ids_of_pieces_are_those_of_whole_texts():
    path = tokens.default_path()
    atoms = ["a", "B", "'s", "'", "'RE", "reading", "1", "23", "²", "é", "É", "́", "̸", "—", ".", "!!", " ", "  ", "\t", "\n", "\xa0", " ", "İ", "ß", "Σ"]
    atoms += ["<|", "<|endoftext|>", "<|ENDOFTEXT|>", "</w>", "日本", "🙂", "\x00", "\x1c", "$", "x9", "don't", "'S", "\x85", "ﬁ", "Å", "٣", "हि"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(atoms, k=rng.randint(0, 12))) for _ in range(5000)] + ["", None]
    plain_ids = tokens._tokenizer(path).encode_batch(["" if t is None else t for t in texts], add_special_tokens=False)
    for row, ids, at in tokens.encoded(pa.array(texts), path, 2):
        for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            assert ids[a:b].tolist() == [*plain_ids[row + i].ids, 2]
