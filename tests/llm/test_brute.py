"""Operators that SQL cannot express, against plain versions."""

import glob
import hashlib
import io
import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grantlens.llm import ann, components, edits, fingerprints, langid, line_dedup, lines, lm_scoring, mixing, packing, sharding, simhash_dedup, warc
from grantlens.llm.common import fresh_path, shared_dir
from grantlens.llm.components import connected_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_jump_hash_moves_little():
    keys = np.arange(20_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = sharding.jump_hash(keys, 10), sharding.jump_hash(keys, 12)
    assert set(b[a != b]) == {10, 11} and abs((a != b).mean() - 2 / 12) < 0.02 and np.bincount(a).min() > 1800


def test_suffix_scores():
    rng = random.Random(3)
    corpus = [[rng.choice("abcde") for _ in range(rng.randint(1, 60))] for _ in range(40)]
    items = [[rng.choice("abcdex") for _ in range(30)] for _ in range(10)] + [corpus[3] + corpus[7]]

    def seen(gram):
        return sum(t[i : i + len(gram)] == gram for t in corpus for i in range(len(t) - len(gram) + 1))

    code = lambda t: np.array([ord(c) for c in t], np.uint64)
    words = np.concatenate([code(t) for t in items])
    sizes = np.array([len(t) for t in items])
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    blocks = [(code(t), 0, 0) for t in corpus]
    longest, context, joined, single = lm_scoring.shard_counts(blocks, words, first)
    at = 0
    for t in items:
        for i in range(len(t)):
            n = max(d for d in range(i + 1) if d == 0 or seen(t[i - d : i]))
            assert longest[at] == n and context[at] == (seen(t[i - n : i]) if n else 0)
            assert joined[at] == (seen(t[i - n : i + 1]) if n else 0) and single[at] == seen([t[i]])
            at += 1


def test_scores_do_not_depend_on_shards(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = lm_scoring.score_texts(documents.coalesce(1), items).orderBy("item_id").collect()
    many = lm_scoring.score_texts(documents.repartition(5), items, shard_tokens=3000).orderBy("item_id").collect()
    assert one == many and max(r.longest_match for r in one) > 20


def test_scores_against_a_plain_version(spark):
    rng = random.Random(4)
    corpus = [[rng.choice("abcdefg") for _ in range(rng.randint(1, 40))] for _ in range(30)] + [[rng.choice("abcdefg") for _ in range(900)], ["z"]]
    items = [[rng.choice("abcdefgxy") for _ in range(rng.randint(1, 25))] for _ in range(8)] + [corpus[3], corpus[-2][50:90], ["q", "r"]]
    grams = Counter(tuple(t[i : i + d]) for t in corpus for i in range(len(t)) for d in range(1, 42) if i + d <= len(t))
    t, v = sum(map(len, corpus)), len({w for x in corpus for w in x})
    want = {}
    for k, x in enumerate(items):
        logs, longs = 0.0, []
        for i in range(len(x)):
            n = max(d for d in range(i + 1) if d == 0 or grams[tuple(x[i - d : i])])
            p0 = (grams[(x[i],)] + 1) / (t + v + 1)
            logs += math.log((grams[tuple(x[i - n : i + 1])] + p0) / ((grams[tuple(x[i - n : i])] if n else t) + 1))
            longs.append(n)
        want[k] = (len(x), round(logs, 6), round(math.exp(-logs / len(x)), 4), round(sum(longs) / len(x), 6), max(longs))
    docs = spark.createDataFrame([(" ".join(x),) for x in corpus], "text string").repartition(3)
    asked = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id int, text string")
    for options in ({}, {"shard_tokens": 50}, {"shard_tokens": 64, "pass_tokens": 40}):  # a text longer than a shard is cut; several passes
        got = {r.item_id: (r.n_tokens, r.log_prob, r.perplexity, r.mean_match, r.longest_match) for r in lm_scoring.score_texts(docs, asked, **options).collect()}
        assert len(got) == len(want)
        for k in want:
            assert got[k] == pytest.approx(want[k], rel=1e-4, abs=2e-4), (options, k)


def test_suffixes_of_many_words():
    text = np.random.default_rng(1).permutation(np.r_[np.arange(1, 2_300_000), np.arange(1, 1000)])
    order = lm_scoring.suffix_array(text, 4)
    first = text[order]
    assert (first[1:] >= first[:-1]).all() and len(np.unique(order)) == len(text)


def plain_pack(docs, window):
    """Seeds in order; the best-scored unused document that fits, again and again."""
    n, length = len(docs), [len(d) for d in docs]
    mean = sum(length) / n
    df = Counter(w for d in docs for w in set(d))
    idf = {w: max(0.0, math.log((n - df[w] + 0.5) / (df[w] + 0.5))) for w in df}
    tf = [Counter(d) for d in docs]

    def score(q, d):
        return round(sum(idf[w] * tf[d][w] * 2.2 / (tf[d][w] + 1.2 * (0.25 + 0.75 * length[d] / mean)) for w in set(docs[q]) if tf[d][w]), 9)

    used, out = set(), []
    for s in range(n):
        if s in used:
            continue
        used.add(s)
        mine, room = [s], window - length[s]
        for d in sorted((d for d in range(n) if d not in used), key=lambda d: (-score(s, d), d)):
            if length[d] <= room:
                mine.append(d)
                room -= length[d]
        used.update(mine)
        out.append(mine)
    return out


def test_packing_is_greedy(spark, documents):
    rows = [r for r in documents.orderBy("doc_id").collect() if len(r.text.split()) <= 600]
    got = packing.pack_documents(spark.createDataFrame(rows, documents.schema), 600, shard_tokens=10**9).collect()
    mine = {}
    for r in sorted(got, key=lambda r: (r.window, r.position)):
        mine.setdefault(r.window, []).append(r.doc_id)
    want = [[rows[i].doc_id for i in w] for w in plain_pack([r.text.split() for r in rows], 600)]
    assert list(mine.values()) == want


def test_packing_does_not_depend_on_shards(spark, documents):
    rows = [r for r in documents.orderBy("doc_id").collect() if len(r.text.split()) <= 600]
    got = packing.pack_documents(spark.createDataFrame(rows, documents.schema), 600, shard_tokens=4000).collect()
    assert len({r.shard for r in got}) > 3
    mine = {}
    for r in sorted(got, key=lambda r: (r.window, r.position)):
        mine.setdefault((r.shard, r.window), []).append(r.doc_id)
    assert sorted(mine.values()) == sorted([rows[i].doc_id for i in w] for w in plain_pack([r.text.split() for r in rows], 600))


def test_packing_asks_few_seeds_for_each_window():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 3000)
    sizes[rng.random(3000) < 0.1] = 1  # every seed would take the same small pieces, which score nothing
    parts, score = np.array_split(np.arange(3000), 4), {}
    filler, asked, rounds = packing.Filler(sizes, 2048), 0, 0

    def points(seed):
        if seed not in score:
            mine = np.random.default_rng(seed)
            score[seed] = np.where((mine.random(3000) < 0.3) & (sizes > 1), mine.integers(1, 50, 3000), 0)
        return score[seed]

    def found(seed, room, part, keep):
        at = part[filler.free[part] & (sizes[part] <= room) & (points(seed)[part] > 0)]
        out = np.empty(len(at), packing.FOUND)
        out["score"], out["num"], out["size"] = points(seed)[at], at, sizes[at]
        return packing.best_of(out, filler.classes, keep)

    while filler.open or filler.free.any():
        keep = 32 << filler.stuck
        seeds, rooms = filler.seeds(200)
        asked, rounds = asked + len(seeds), rounds + 1
        filler.fill(seeds, [[found(s, r, x, keep) for x in parts] for s, r in zip(seeds.tolist(), rooms.tolist())], keep)
    used, want = np.zeros(3000, bool), []
    for s in range(3000):
        if not used[s]:
            mine, room = [s], 2048 - sizes[s]
            used[s] = True
            for d in np.lexsort((np.arange(3000), -points(s))).tolist():
                if not used[d] and sizes[d] <= room:
                    mine.append(d)
                    used[d], room = True, room - sizes[d]
            want.append(mine)
    assert filler.done == want and asked < 4 * len(want) and rounds < 40


def test_packing_writes_each_posting_once_forward_and_once_inverted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    postings = sum(len(set(r.text.split())) for r in docs.collect() if r.text)

    def size():
        return sum(x.stat().st_size for x in Path(shared_dir(spark).removeprefix("file://")).rglob("grantlens-pack-*/*.parquet"))

    before = size()
    packing.pack_documents(docs)
    assert size() - before < 12 * postings  # 6 bytes forward, 4 inverted and 8 for each term of a block, as compressed


def test_packing_block_finds_the_best_of_every_class():
    rng = np.random.default_rng(5)
    nums, sizes = np.sort(rng.choice(9000, 700, replace=False)), rng.integers(1, 300, 700)
    terms = [np.unique(rng.zipf(1.3, 40) % 500).astype(np.uint32) for _ in range(700)]
    counts = [rng.integers(1, 4, len(x)).astype(np.uint16) for x in terms]
    free, classes, known = rng.random(700) < 0.8, packing.size_classes(300), np.arange(500, dtype=np.uint32)
    idf = rng.random(500) * 5
    block = packing.Block(nums, sizes, packing.postings(nums, terms, counts), free, known, idf, 100.0, classes, packing.exact_scale(300, 700))
    rooms = rng.integers(50, 300, 40)
    held, got = block.search([x.astype(np.int32) for x in terms[:40]], rooms, 6)
    ends = np.cumsum(held)
    for q in range(40):
        each = []
        for d in np.flatnonzero(free & (sizes <= rooms[q])).tolist():
            tf = dict(zip(terms[d].tolist(), counts[d].tolist()))
            score = sum(idf[w] * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * sizes[d] / 100)) for w in terms[q].tolist() if w in tf)
            if round(score * 1e9) > 0:
                each.append((round(score * 1e9), int(nums[d]), int(sizes[d])))
        want = {x[1] for c in classes for x in sorted((x for x in each if x[2] <= c), key=lambda x: (-x[0], x[1]))[:6]}
        assert set(got[ends[q] - held[q] : ends[q]]["num"].tolist()) == want


def test_packing_keeps_every_word(documents):
    got = packing.pack_documents(documents, 256, shard_tokens=5000).collect()
    spans = {}
    for r in got:
        spans.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    for r in documents.collect():
        end = 0
        for start, n in sorted(spans[r.doc_id]):
            assert start == end
            end += n
        assert end == len(r.text.split())
    room = Counter()
    for r in got:
        if r.shard >= 0:
            room[r.shard, r.window] += r.n_tokens
    assert max(room.values()) <= 256 and len({r.shard for r in got}) > 3


def test_simhash_groups(spark, documents):
    got = {r.id: r.keep_id for r in simhash_dedup.near_groups(documents).collect()}
    each = simhash_dedup.fingerprints(documents, "doc_id", "text").collect()
    fp = np.array([np.frombuffer(r.fp, "<u8") for r in each])
    near = fingerprints.distance(fp[:, None].repeat(len(fp), 1).reshape(-1, 5), np.tile(fp, (len(fp), 1))).reshape(len(fp), -1)
    bound = simhash_dedup.manhattan(fp[:, None].repeat(len(fp), 1).reshape(-1, 5), np.tile(fp, (len(fp), 1))).reshape(len(fp), -1)
    assert (bound <= near).all()
    pairs = [(each[i].id, each[j].id) for i, j in zip(*np.nonzero(near <= simhash_dedup.MOST_BITS)) if i < j]
    found = sum(got.get(a) is not None and got.get(a) == got.get(b) for a, b in pairs)
    assert pairs and found >= 0.95 * len(pairs)


@pytest.mark.parametrize("block", [10**6, 70])
def test_every_close_pair_is_found(spark, monkeypatch, block):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    one = rng.integers(0, 2, (150, 320), dtype=np.uint8)
    two = one.copy()
    for k in range(150):
        two[k, rng.permutation(320)[: 20 + k % 45]] ^= 1  # 20 to 64 bits
    fp = np.packbits(np.concatenate([one, two]), axis=1, bitorder="little")
    table = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(fp)], "node bigint, fp binary").repartition(3)
    got = [tuple(r) for r in fingerprints.all_pairs(table, 300, 5, 58).collect()]
    whole = np.bitwise_count(fp[:, None] ^ fp[None]).sum(axis=2)
    want = [(int(i), int(j), int(whole[i, j])) for i, j in zip(*np.nonzero(whole <= 58)) if i < j]
    assert len(want) > 120 and sorted(got) == sorted(want)


def test_pipeline_stage_keeps_one_of_each_connected_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    each = simhash_dedup.fingerprints(docs, "doc_id", "text").collect()
    fp = np.array([np.frombuffer(r.fp, "<u8") for r in each])
    root = {r.id: r.id for r in each}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]).sum(axis=1) <= simhash_dedup.MOST_BITS) + i + 1:
            a, b = find(each[i].id), find(each[j].id)
            root[max(a, b)] = min(a, b)
    got = {r.id: r.keep_id for r in simhash_dedup.near_groups(docs).collect()}
    assert {k: got.get(k, k) for k in root} == {k: find(k) for k in root}
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in simhash_dedup.near_dedup(docs).select("doc_id").collect()}
    assert gone == {k for k in root if find(k) != k}


def test_connected_groups_of_many_edges(spark, monkeypatch):
    monkeypatch.setattr(components, "LOCAL_EDGES", 50)
    batches = [pa.RecordBatch.from_arrays([pa.array([i] * 30), pa.array(range(i + 1, i + 31))], ["a", "b"]) for i in range(20)]
    got = [x.to_pydict() for x in components._contract(iter(batches))]
    edges = [(a, b) for x in got for a, b in zip(x["node"], x["root"])]
    node, root = components.forest(*map(np.array, zip(*edges)))
    assert max(len(x["node"]) for x in got) <= 110 and dict(zip(node.tolist(), root.tolist())) == dict.fromkeys(range(50), 0)


def test_connected_groups(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in connected_groups(spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)).collect()}
    assert all(find(k) == v for k, v in got.items()) and {x for e in edges if e[0] != e[1] for x in e} <= set(got)


def test_lines_by_edit_distance(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(14)) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, "intro %d unlike\n" % k + t + "s") for k, t in enumerate(base)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    gone = {r.doc_id for r in got if r.doc_id >= 100 and "\n" not in r.text and r.lines_removed}
    assert len(gone) >= 27 and all(r.text for r in got if r.doc_id < 100)


def test_many_edit_distances():
    rng = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    xs, ys = [], []
    for _ in range(500):
        a = [rng.choice(words) + rng.choice(["", "é", "𝒳"]) for _ in range(rng.choice([1, 3, 8, 20, 40, 90]))]
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 5))):
            i = rng.randrange(len(b))
            b[i : i + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
        xs.append(" ".join(a)), ys.append(" ".join(b))
    most = [int(max(len(x), len(y)) * 0.1) for x, y in zip(xs, ys)]
    want = [edits.distance(x, y) <= m for x, y, m in zip(xs, ys, most)]
    assert edits.within_all(xs, ys, most).tolist() == want and 0.1 < np.mean(want) < 0.9


def test_line_features():
    raw = ["The  cat, sat: 12.50 times!", "", "...", "Ünï «code» 7𝒳 ٣٤", "a", " lead and trail ", "x" * 3000, "the cat sat 9 7 times"]
    normal, fp, sketch = lines.features(raw)
    assert normal == ["the cat sat 0 0 times", "", "", "ünï code 0𝒳 ٣٤", "a", "lead and trail", "x" * 3000, "the cat sat 0 0 times"]
    assert normal == lines.normal_lines(pa.array(raw)).to_pylist() and (fp[0] == fp[7]).all() and (sketch[0] == sketch[7]).all()
    assert not sketch[1].any() and not fp[2].any() and all(sketch[i].any() for i in (0, 3, 4, 5, 6))


def test_lines_do_not_depend_on_the_division(spark, monkeypatch):
    rng = random.Random(9)
    rows, kinds = [], [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(20)) for _ in range(60)]
    for k in range(240):  # one hot cell: all begin alike; four lines of each kind
        t = "all rights reserved by " + kinds[k % 60]
        rows.append((k, t + rng.choice(["", " it", " so"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(tuple(r) for r in line_dedup.dedup_lines(docs).collect())
    assert sum(r[2] for r in want) == 180
    monkeypatch.setattr(line_dedup, "HOT_ROWS", 20), monkeypatch.setattr(line_dedup, "SAMPLED", 1)
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(docs).collect()) == want
    assert sorted(tuple(r) for r in line_dedup.dedup_lines(docs, node_bits=5).collect()) == want  # many keys share a number


def test_real_lines_by_edit_distance(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    raw = sorted({x for t in texts for x in t.split("\n") if 6 <= len(x.split()) <= 25})
    norm = lines.normal_lines(pa.array(raw)).to_pylist()
    raw, norm = zip(*{n: (x, n) for x, n in zip(raw, norm) if n}.values())
    parts = [Counter(n) for n in norm]
    order = sorted(range(len(norm)), key=lambda i: len(norm[i]))
    near = {}
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            most = int(len(norm[j]) * 0.1 + 1e-9)
            if len(norm[j]) - len(norm[i]) > most:
                break
            if (parts[j] - parts[i]).total() <= most and edits.within(norm[i], norm[j], most):
                near.setdefault(i, []).append(j), near.setdefault(j, []).append(i)
    want, seen = set(), set()
    for i in range(len(raw)):
        if i in seen:
            want.add(i)
        todo = [i] if i in near else []
        while todo:
            if (x := todo.pop()) not in seen:
                seen.add(x)
                todo += near[x]
    rows = spark.createDataFrame(list(enumerate(raw)), "doc_id bigint, text string")
    gone = {r.doc_id for r in line_dedup.dedup_lines(rows).collect() if r.lines_removed}
    assert len(want) > 30 and gone <= want and len(gone) >= 0.95 * len(want)


def test_neighbours_recall():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((3000, 64)) + 2 * rng.standard_normal((20, 64))[rng.integers(0, 20, 3000)]).astype(np.float32)
    ids, turn = np.arange(3000), ann.rotation(64, ann.BITS)
    best = ann.Best(150, 10)
    for a in range(0, 3000, 1000):  # three blocks, one after the other
        ann.search_block(ids[::20], x[::20], ids[a : a + 1000], x[a : a + 1000], ann.encode(x[a : a + 1000], turn), turn, best, ann.EPSILON)
    full = x[::20].astype(float) @ x.T.astype(float)
    full[np.arange(150), ids[::20]] = -np.inf
    want = np.argsort(-full, axis=1)[:, :10]
    assert np.mean([len(set(want[q]) & set(best.ids[q])) / 10 for q in range(150)]) > 0.98


def test_bit_products():
    rng = np.random.default_rng(2)
    q, x, turn = rng.standard_normal((5, 40)).astype(np.float32), rng.standard_normal((9, 40)).astype(np.float32), ann.rotation(40, 128)
    codes, scale, error = ann.encode(x, turn)
    bits, low, step, total = ann.planes(q, turn)
    u = np.rint((q @ turn - low[:, None]) / step[:, None])
    ones = np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little")
    assert (ann.bit_products(codes, bits) == u @ ones.T).all()
    assert codes.shape == (9, 2)
    guess = (2 * (low[:, None] * ones.sum(1) + step[:, None] * ann.bit_products(codes, bits)) - total[:, None]) / np.sqrt(128) * scale
    slack = 5 * (np.linalg.norm(q, axis=1)[:, None] * error + 0.41 * step[:, None] * scale)
    assert (np.abs(guess - q @ x.T) <= slack).all()


def test_neighbours_of_queries(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 24)).astype(np.float32).round(1)
    x[::50] = x[1::50]  # ties
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>").repartition(5)
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), 5).collect():
        got.setdefault(r.vec_id, {})[r.rank] = r.neighbour
    full = x.astype(float) @ x.T.astype(float)
    for q in range(0, 700, 20):
        order = [j for j in np.lexsort((np.arange(700), -full[q].round(9))) if j != q][:5]
        assert [got[q][r] for r in range(1, 6)] == order


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    model = langid.fit(docs.filter("doc_id % 2 = 0"), "text", "lang", "doc_id")
    rest = docs.filter("doc_id % 2 = 1").dropDuplicates(["text"]).join(docs.filter("doc_id % 2 = 0").select("text"), "text", "left_anti").cache()
    found = {bytes(r.key): r for r in langid.identify(rest, model, "doc_id", F.col("text"), None, None, F.col("source")).collect()}  # nothing is declared
    got = [(r.lang, found[bytes(r.k)].lang) for r in rest.select("lang", langid.row_key(F.col("doc_id"), F.col("text")).alias("k")).collect()]
    assert len(got) > 300 and np.mean([a == b for a, b in got]) > 0.95


def test_language_fusion(spark, documents):
    got = langid.label_documents(documents).collect()
    known = {r.doc_id: r.lang for r in documents.collect()}
    assert len(got) == len(known) and np.mean([r.accepted for r in got]) >= 0.98 and np.mean([known[r.doc_id] == r.detected for r in got if r.accepted]) > 0.97
    # plain version of the fusion on a few rows
    scored = spark.createDataFrame([(b"1", "de", None, "h", [0.0, -1.0], [0.7, 0.3]), (b"2", "en", None, "h", [-2.0, 0.0], [0.1, 0.9]), (b"3", None, "fr", None, [-0.1, 0.0], [0.4, 0.6])], "key binary, declared string, suffix string, host string, ll array<double>, p array<double>")
    got = {bytes(r.key): r for r in langid.fuse(scored, ["de"], 0.0).collect()}
    rows = scored.collect()
    for r in rows:
        others = [o for o in rows if o.key != r.key]
        prior = np.array([sum(o.p[k] for o in others) + 1 for k in (0, 1)])
        prior /= prior.sum()
        for col in ("suffix", "host"):
            same = [o for o in others if r[col] is not None and o[col] == r[col]]
            prior = np.array([sum(o.p[k] for o in same) for k in (0, 1)]) + langid.KAPPA * prior
            prior /= prior.sum()
        logp = np.array(r.ll) + np.log(prior)
        if r.declared:
            said = [o for o in others if o.declared]
            logp += np.log([(sum(o.p[k] for o in said if o.declared == r.declared) + 1) / (sum(o.p[k] for o in said) + 2) for k in (0, 1)])
        p = np.exp(logp) / np.exp(logp).sum()
        x = got[bytes(r.key)]
        assert x.lang == ("de", "und")[int(p.argmax())] and abs(x.posterior - p.max()) < 1e-9


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    digests = []
    for parts in (1, 7):
        to = fresh_path(spark, "warc-test")
        index = warc.write_warc(pages.repartition(parts), to, roll_bytes=20_000, range_bytes=150_000)
        assert index.count() == pages.count()
        back = warc.read_warc(spark, to)
        assert back.select("page_id", "url", "html").exceptAll(pages.select("page_id", "url", "html")).count() == 0 and back.count() == pages.count()
        root = to.removeprefix("file://")
        files = sorted(glob.glob(f"{root}/part-*"))
        for r in index.collect()[::7]:  # offsets and lengths of the index point to the records
            with open(f"{root}/{r.file}", "rb") as f:
                f.seek(r.offset)
                ((head, block),) = warc.parse_members(io.BytesIO(f.read(r.length)))
            assert head["X-Row-ID"] == str(r.page_id) and head["WARC-Payload-Digest"] == r.payload_digest
        digests.append([hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files])
        assert not glob.glob(f"{root}/_tmp*") and len(files) > 3
    assert digests[0] == digests[1]


@pytest.mark.parametrize("weights, default", [(None, 0.0), ({"a": 3.0, "b": 1.0}, 0.0), ({"a": 0.2}, 1.0)])
def test_mixing_to_weights(spark, weights, default):
    rng = random.Random(6)
    rows = [(i if i % 7 else i // 70, " ".join("w" * 1 for _ in range(rng.randint(0, 30))), "aabbbc"[i % 6] if i % 11 else None) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = Counter((r.doc_id, r.source, r.n_tokens, r.level) for r in mixing.mix_levels(docs, [0.2, 0.7], weights, default).collect())
    h = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16)
    sources = {s for _, _, s in rows}
    weight = {s: 1.0 if weights is None else weights.get(s, default) for s in sources}
    total, want = sum(len(t.split()) for _, t, _ in rows), Counter()
    for s in sources:
        for i, t, _ in (r for r in rows if r[2] == s):
            up_to = sum(len(u.split()) for j, u, o in rows if o == s and h(j) <= h(i))
            fits = [k for k, b in enumerate((0.2, 0.7)) if up_to <= total * b * weight[s] // sum(weight.values())]
            if fits:
                want[i, s, len(t.split()), fits[0]] += 1
    assert got == want and sum(got.values()) > 200


def test_line_order():
    """One number sorts as (id, NULLs last, text hash, line), whatever the id."""
    ids, md5 = [None, -(2**63), 2**63 - 1, 0, -1, 5, 5], [hashlib.md5(str(i).encode()).digest() for i in range(7)]
    kind = pa.struct([("none", pa.bool_()), ("id", pa.int64()), ("md5", pa.binary())])
    doc = pa.array([{"none": i is None, "id": i, "md5": m} for i, m in zip(ids, md5)], kind)
    owner, line = np.repeat(np.arange(7), 3), np.tile([0, 7, 2**31 - 1], 7)
    key = lambda o, n: (((1 << 64 if ids[o] is None else ids[o] + (1 << 63)) << 55) + (int.from_bytes(md5[o][:3], "big") << 31)) + int(n)
    assert [int(x) for x in line_dedup._order(doc, owner, line).to_pylist()] == [key(o, n) for o, n in zip(owner, line)]
