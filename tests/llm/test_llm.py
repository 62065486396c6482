"""Each operator against a plain version on small fixtures, and the cases its docstring names."""

import collections
import hashlib
import json
import textwrap
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.llm import ann, flac, langid, licences, line_dedup, mixing, near_dups, packing, substring, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{i}" for i in rng.integers(0, vocabulary, n))


# ------------------------------------------------------------------------------------- 6 line dedup


def plain_lines(rows, min_chars=40, min_docs=5):
    blank, holders = " \t\n\x0b\x0c\r", collections.defaultdict(set)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blank))
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and d is not None:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup_matches_plain_version(spark):
    rng = np.random.default_rng(1)
    common = [words(rng, 12) for _ in range(6)] + ["é" * 40, "x" * 39]
    rows = []
    for d in range(60):
        lines = [words(rng, 12) for _ in range(3)] + [f" \t{common[i].upper() if d % 2 else common[i]}\x0c" for i in rng.integers(0, len(common), 3)]
        rows.append((d, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, f"{common[0]}\nb"), (103, "\n".join([common[1]] * 4)), (103, "\n".join([common[1]] * 4)), (104, words(rng, 20000))]
    got = line_dedup.dedup_lines(docs_of(spark, rows)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == plain_lines(rows)
    assert any(r[2] for r in got)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(docs_of(spark, []).withColumn("line", F.lit(1)).withColumn("h1", F.lit(2))).collect() == []


def test_runs_compact_and_report_novel_hashes(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for batch in range(4):
        lines = spark.createDataFrame([(batch * 10 + i, i % 3 + batch, 0) for i in range(6)], "doc_id long, h1 long, h2 long")
        novel = {r.h1 for r in runs.add(lines).collect()}
        assert novel == ({0, 1, 2} if batch == 0 else {batch + 2})
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert {r.h1: r.docs for r in runs.totals().collect()} == {0: 2, 1: 4, 2: 6, 3: 6, 4: 4, 5: 2}
    runs.close()


# ------------------------------------------------------------------------------------- 7 mixing


def test_targets_stop_at_twice_the_size():
    got = mixing.targets({"a": 10, "b": 1000, "c": 1000, None: 5}, 2015)
    assert got["a"] == 20 and got[None] == 10
    assert sum(got.values()) == Fraction(3, 2) * 2015 and got["b"] == 2 * got["c"]
    assert mixing.targets({"a": 0}, 0) == {"a": 0} and mixing.targets({}, 0) == {}


def test_flow_prefers_first_copies():
    # Source 0 may draw on both patterns, source 1 only on the second: the second is left to it.
    flow = mixing.min_cost_flow({0: 10, 1: 10}, {0: 10, 1: 10}, [(0, 0), (1, 0), (1, 1)])
    assert flow == {(0, 0): 10, (1, 0): 0, (1, 1): 10}
    assert sum(mixing.min_cost_flow({0: 3}, {0: 100}, [(0, 0)]).values()) == 6


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(d, words(rng, int(rng.integers(0, 60))), s) for d, s in enumerate(rng.choice(["a", "b", "c", None], 300, p=[0.7, 0.1, 0.1, 0.1]).tolist())]
    rows += [(1000, None, "a"), (1001, "\n ", None), (5, "twice here", "b"), (5, "twice here", "b"), (None, "no id", "c")]
    got = mixing.sizes_and_taken(docs_of(spark, rows)).collect()
    again = mixing.mix(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.size, r.taken) for r in got) == sorted((r.doc_id or -1, r.size, r.taken) for r in again)
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in got:
        by[r.target][0] += r.taken
        by[r.target][1] = r.target
    assert all(abs(taken - target) <= 2 for taken, target in by.values())
    mixed = mixing.repeated(mixing.mix(docs_of(spark, rows)))
    assert mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in got)


def test_mix_of_overlapping_sources_and_of_nothing(spark):
    docs = docs_of(spark, [(i, "a b c d", "x") for i in range(40)]).withColumn("m", F.when(F.col("doc_id") < 20, F.array(F.lit("p"), F.lit("q"))).otherwise(F.array(F.lit("q"))))
    got = mixing.mix(docs, F.col("m")).collect()
    assert sum(r.taken for r in got) == 240 and all(r.taken <= 8 for r in got)
    assert mixing.mix(docs_of(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(docs_of(spark, [(1, None), (2, "")])).collect()] == [0, 0]


# ------------------------------------------------------------------------------------- 9 packing


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(3)
    texts = [None, "", "Hello, World's 12 tests… naïve", "<|endoftext|> x", "é" * 3 + " ́a", "don't stop.", "İstanbul ΣΑΣ"] + [words(rng, int(n)) for n in rng.integers(1, 900, 60)] + [words(rng, 6000)]
    docs = docs_of(spark, list(enumerate(texts)) + [(2, texts[2])]).coalesce(1).withColumn("length", F.lit(1)).withColumn("offset", F.lit(1))
    rows = packing.pack(docs, path).collect()
    full = Tokenizer.from_file(path)
    ids = {d: np.array(full.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in enumerate(texts)}
    seen = collections.Counter()
    by = collections.defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
        by[r.sequence_id].append((r.offset, r.length))
    assert all(seen[d] == len(x) * (2 if d == 2 else 1) for d, x in ids.items())
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # full or a power of two
    assert packing.pack(docs_of(spark, []), path).collect() == []


def test_packing_keeps_control_characters(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    full = Tokenizer.from_file(path)
    blanks = [chr(c) for c in (*range(1, 33), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    texts = ["\x1c\x1d", *(f"ab{c}cd {c}{c}, Ef{c}" for c in blanks)]
    ids = {d: np.array(full.encode(t, add_special_tokens=False).ids + [1], "<u4") for d, t in enumerate(texts)}
    for r in packing.pack(docs_of(spark, list(enumerate(texts))), path).collect():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32, texts[r.doc_id]


def test_sum_of_squares_places_like_the_definition():
    rng = np.random.default_rng(4)
    fast = packing.SumOfSquares(16)
    levels = [0] * 17
    for i, a in enumerate(rng.integers(1, 16, 400).tolist()):
        def after(h):
            new = list(levels)
            if h:
                new[h] -= 1
            if h + a < 16:
                new[h + a] += 1
            return sum(x * x for x in new[1:16])

        options = [h for h in range(17 - a) if h == 0 or levels[h]]
        best = min(after(h) for h in options)
        fast.place((i, 0, None, a), a)
        new = fast.levels.tolist()
        assert sum(x * x for x in new[1:16]) == best
        levels = new


# ------------------------------------------------------------------------------------- 3 toxicity


def test_toxicity_learns_and_handles_cases(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for d in range(300):
        bad = d % 4 == 0
        rows.append((d, words(rng, 60) + (" you utter numpty" * 2 if bad else "")))
        labels.append((d, 1, int(bad)))
    docs = docs_of(spark, rows)
    table = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, table, F.col("doc_id") % 3 != 1)
    tests = docs_of(spark, [(1, "you utter numpty"), (2, "w1 w2 w3"), (3, None), (4, ""), (None, "x"), (4, "")])
    got = {(r.doc_id, r.text): r.score for r in toxicity.scored(tests, model).collect()}
    assert got[1, "you utter numpty"] > 0.7 > 0.5 > got[2, "w1 w2 w3"]
    assert got[3, None] == got[4, ""] and all(0 <= s <= 1 for s in got.values())
    held = [r for r in toxicity.scored(docs, model).collect() if r.doc_id % 3 == 1]
    assert np.mean([(r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held]) > 0.95
    one = toxicity.train(docs, table.where("toxic = 0"))
    assert toxicity.scored(tests, one).agg(F.max("score")).first()[0] < 1e-9
    assert toxicity.scored(tests, toxicity.train(docs_of(spark, []), table)).count() == 6


# ------------------------------------------------------------------------------------- 4 FLAC


def _stream(x, subframe_bits, n=None, number=0):
    """A one-frame stream around hand-made subframe bits."""
    n = len(x) if n is None else n
    body = np.packbits(np.array(subframe_bits, np.uint8)).tobytes()
    f = flac._header(number, n) + body
    row = np.frombuffer(f, np.uint8)[None]
    f += int(flac.crc16_rows(row, np.array([len(f)]))[0]).to_bytes(2, "big")
    info = n.to_bytes(2, "big") * 2 + len(f).to_bytes(3, "big") * 2 + (8000 << 44 | 7 << 36 | n).to_bytes(8, "big") + hashlib.md5(np.array(x, np.int8).tobytes()).digest()
    seek = (0).to_bytes(16, "big") + n.to_bytes(2, "big")
    return b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(seek).to_bytes(3, "big") + seek + f


def _bits(value, width):
    return [value >> i & 1 for i in range(width - 1, -1, -1)]


def _rice(values, order, n, parts, k, wide=False, escape=()):
    out = _bits(int(wide), 2) + _bits(parts, 4)
    size, at = n >> parts, 0
    for p in range(1 << parts):
        count = size - order if p == 0 else size
        part, at = values[at : at + count], at + count
        width = 5 if wide else 4
        if p in escape:
            out += _bits((1 << width) - 1, width) + _bits(9, 5)
            for v in part:
                out += _bits(v & 511, 9)
            continue
        out += _bits(k, width)
        for v in part:
            u = v * 2 if v >= 0 else -2 * v - 1
            out += [0] * (u >> k) + [1] + (_bits(u & ((1 << k) - 1), k) if k else [])
    return out


@pytest.mark.parametrize("order", [0, 1, 2, 3, 4])
@pytest.mark.parametrize(("parts", "k", "wide", "escape"), [(0, 3, False, ()), (2, 0, False, (1,)), (3, 5, True, (0, 7)), (4, 2, False, ())])
def test_flac_decodes_fixed_predictors_and_partitions(order, parts, k, wide, escape):
    rng = np.random.default_rng(order)
    x = np.clip(np.cumsum(rng.integers(-4, 5, 192)), -128, 127)
    e = np.diff(x, n=order) if order else x
    bits = _bits(0x10 | order << 1, 8) + [b for v in x[:order] for b in _bits(int(v) & 255, 8)] + _rice([int(v) for v in e], order, 192, parts, k, wide, escape)
    (blocks,) = flac.decode_batch([_stream(x, bits)])
    assert blocks[0][1].tolist() == x.tolist()


def test_flac_decodes_linear_predictor():
    rng = np.random.default_rng(9)
    coef, shift, order = [5, -3, 1], 2, 3
    e, x = [], [3, -5, 7]
    for n in range(3, 192):
        p = sum(c * x[n - 1 - j] for j, c in enumerate(coef)) >> shift
        v = int(np.clip(p + rng.integers(-9, 10), -128, 127))
        e.append(v - p)
        x.append(v)
    bits = _bits(0x40 | (order - 1) << 1, 8) + [b for v in x[:3] for b in _bits(v & 255, 8)] + _bits(4, 4) + _bits(shift, 5) + [b for c in coef for b in _bits(c & 31, 5)] + _rice(e, 3, 192, 2, 4)
    (blocks,) = flac.decode_batch([_stream(x, bits)])
    assert blocks[0][1].tolist() == x


def test_flac_round_trip_and_checks(spark):
    rng = np.random.default_rng(6)
    texts = [None, "", "a", "x" * 5000, words(rng, 4000), words(rng, 150), "é中" * 300, "a"]
    payloads = [flac.payload(t)[1] for t in texts] + [rng.integers(0, 256, 6400).astype(np.uint8).tobytes(), bytes(64 * 40)]
    streams = flac.encode_batch(payloads)
    for p, blocks in zip(payloads, flac.decode_batch(streams), strict=True):
        assert b"".join((b.view(np.uint8) ^ np.uint8(128)).tobytes() for _, b in blocks) == p
        assert [first for first, _ in blocks] == list(range(0, len(p), flac.BLOCK))
    assert streams[2] == streams[7] and len(streams[3]) < 400
    for at in (-1, -30, 60):
        broken = bytearray(streams[4])
        broken[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode_batch([bytes(broken)])
    with pytest.raises(ValueError):
        flac.decode_batch([streams[4][:-10]])
    docs = docs_of(spark, list(enumerate(texts))).withColumn("media", F.lit(1))
    rows = {r.doc_id: r for r in flac.media_digests(flac.media_column(docs)).collect()}
    for d, t in enumerate(texts):
        n, p = flac.payload(t)
        assert (rows[d].n_bytes, rows[d].payload_sha256, rows[d].tail_crc32) == (n, hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert flac.pcm_blocks(flac.media_column(docs)).agg(F.sum("n_samples")).first()[0] == sum(len(flac.payload(t)[1]) for t in texts)
    assert flac.media_digests(flac.media_column(docs_of(spark, []))).collect() == []


# ------------------------------------------------------------------------------------- 8 substring dedup


def test_substring_matches_plain_version(spark):
    rng = np.random.default_rng(7)
    passages = [words(rng, n) for n in (49, 50, 51, 80, 300)]
    rows = []
    for d in range(80):
        parts = [words(rng, int(rng.integers(0, 90)))]
        for i in rng.integers(0, len(passages), int(rng.integers(0, 3))):
            parts += [passages[i], words(rng, int(rng.integers(0, 40)))]
        rows.append((d, " ".join(parts)))
    tail = rows[3][1].split()
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, "a " * 400), (204, "a " * 300), (205, " ".join(tail[len(tail) // 2 :] + passages[4].split()[100:180])), (206, " ".join(passages[4].split()))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digest(substring.remove_repeats(docs_of(spark, rows).withColumn("tag", F.lit(1)))).collect()}
    assert got == substring.brute_force(rows)


def test_substring_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(8)
    p = words(rng, 120)
    rows = [(1, p), (1, p), (1, "other " + p), (None, p), (2, p)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring.remove_repeats(docs_of(spark, rows)).collect())
    assert got == [(-1, 120, 0), (1, 120, 0), (1, 120, 0), (1, 121, 0), (2, 120, 120)]
    assert substring.remove_repeats(docs_of(spark, [])).collect() == []


# ------------------------------------------------------------------------------------- 1 near duplicates


def plain_alignment(a, b):
    """Matched words of the best alignment, by the usual table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain_classes(rows):
    split = {d: near_dups.words_of((t or "").encode()) for d, t in rows}
    root = {d: d for d in split}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(split)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = split[a], split[b]
            if not x or not y or min(len(x), len(y)) < 0.8 * max(len(x), len(y)) or (collections.Counter(x) & collections.Counter(y)).total() * 9 < 4 * (len(x) + len(y)):
                continue  # so few words in common can't be 0.8 of an alignment
            m = plain_alignment(x, y)
            if m / (len(x) + len(y) - m) >= 0.8 - 1e-12:
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {d: find(d) for d in ids}


def test_near_duplicates_match_plain_version(spark):
    rng = np.random.default_rng(10)
    rows, d = [], 0
    for size, edits in ((1, 0), (30, 3), (60, 6), (2, 1), (40, 12)):
        base = words(rng, 200).split()
        for _ in range(size):
            w = list(base)
            for at in rng.integers(0, len(w), int(rng.integers(0, edits + 1))):
                w[at] = f"e{rng.integers(0, 10**6)}"
            rows.append((d, " ".join(w)))
            d += 1
    rows += [(d + i, words(rng, 150)) for i in range(40)]
    d += 40
    rows += [(d, None), (d + 1, ""), (d + 2, "two words"), (d + 3, "Two, words!"), (d + 4, "!!!"), (d + 5, rows[0][1].upper()), (d + 6, words(rng, 20000))]
    got = {r.doc_id: r.class_id for r in near_dups.digest_rows(docs_of(spark, rows).withColumn("node", F.lit(1)), unit_rows=16).collect()}
    assert got == plain_classes(rows)
    assert got[d] == d and got[d + 1] == d + 1 and got[d + 3] == d + 2 and got[d + 5] == 0


def test_near_duplicates_of_odd_rows(spark):
    got = near_dups.digest_rows(docs_of(spark, [(None, "a b"), (4, "a b"), (4, "a b"), (3, "A b")])).collect()
    assert sorted((r.doc_id or 0, r.class_id) for r in got if r.class_id) == [(3, 3), (4, 3), (4, 3)] and len(got) == 4
    assert near_dups.digest_rows(docs_of(spark, [])).collect() == []


def test_order_sketch_sees_order():
    a = [f"w{i}".encode() for i in range(300)]
    b = a[150:] + a[:150]
    x, y = (near_dups.word_hashes(w).astype(np.uint32) for w in (a, b))
    assert near_dups.aligned_similarity(x, x) == 1 and near_dups.aligned_similarity(x, y) == 0.0
    x, y = near_dups.labelled_runs(a), near_dups.labelled_runs(b)
    assert len(set(near_dups.order_sketches(x)) & set(near_dups.order_sketches(y))) < near_dups.SKETCHES


# ------------------------------------------------------------------------------------- 10 nearest neighbours


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:700] = x[200]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] + [1.0] * 15), (2300, [1.0, None] + [1.0] * 14), (2400, [1.0] * 3), (2500, [float("inf")] + [1.0] * 15), (300, rows[300][1])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    got = ann.PostingLists.fit(table, block_rows=100, query_rows=2).search(table, F.col("vec_id") % 100 == 0, 10).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by[r.query_id].append((r.vec_id, r.score))
    wide, hits = x.astype(np.float64), 0
    assert sorted(by) == list(range(0, 1500, 100))
    for q, found in by.items():
        d = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        d[q] = np.inf
        true = np.lexsort((np.arange(len(d)), d))[:10]
        hits += len(set(true.tolist()) & {v for v, _ in found})
        assert len(found) == 10 and all(abs(d[v] - s) < 1e-12 for v, s in found) and found == sorted(found, key=lambda f: (f[1], f[0]))
    assert hits >= 0.95 * 10 * len(by)


def test_probes_grow_with_the_lists(spark):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(6000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    lists = ann.PostingLists.fit(table, list_rows=10)  # 600 lists, where only a scan of nearly all finds the neighbours
    assert len(lists.graph.points) > 500
    by = collections.defaultdict(set)
    for r in lists.search(table, F.col("vec_id") % 100 == 0, 10).collect():
        by[r.query_id].add(r.vec_id)
    d = ((x[::100, None].astype(np.float64) - x[None]) ** 2).sum(2)
    d[np.arange(60), np.arange(0, 6000, 100)] = np.inf
    assert sum(len(by[i * 100] & set(np.argsort(row)[:10].tolist())) for i, row in enumerate(d)) >= 0.9 * 600


def test_nearest_neighbours_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(100, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [1.0, 1.0])], schema)
    got = ann.PostingLists.fit(few).search(few, F.col("vec_id") % 100 == 0, 10).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(100, 1, 8), (100, 2, 7)]
    none = spark.createDataFrame([], schema)
    assert ann.PostingLists.fit(none).search(none, F.lit(True), 10).collect() == []


# ------------------------------------------------------------------------------------- 2 language, 5 licences


def test_language_evidence(spark):
    rng = np.random.default_rng(12)
    stock = {"xx": ["alpha", "beta", "gamma", "delta"], "yy": ["zorro", "quux", "wibble", "xyzzy"]}
    talk = lambda lang, n: " ".join(rng.choice(stock[lang], n))
    docs = spark.createDataFrame([(i, talk(lang, 40), lang) for i, lang in enumerate(["xx", "yy"] * 20)], "doc_id long, text string, lang string")
    page = lambda lang, n, declared: f'<html lang="{declared}"><script>zorro</script><body>{talk(lang, n)}</body></html>'
    rows = [(i, f"http://a.site.{'yy' if i % 2 else 'xx'}/p", page("yy" if i % 2 else "xx", 30, "yy" if i % 2 else "xx")) for i in range(40)]
    rows += [(100, "https://a.site.yy/q", "<html></html>"), (101, None, None), (102, "nonsense", page("yy", 30, "xx")), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in langid.identify(pages, docs).collect()}
    assert all(got[i].lang == ("yy" if i % 2 else "xx") for i in range(40))
    assert got[100].lang == "yy" and got[102].lang == "yy" and got[101].lang in ("xx", "yy") and got[101].host == ""
    assert langid.identify(pages, docs.where("false")).where("lang IS NULL").count() == len(rows)
    assert langid.identify(pages.where("false"), docs).collect() == []


def test_language_sample_is_of_labelled_rows_and_each_language(spark):
    rows = [(i, f"w{i}", None) for i in range(3000)] + [(5000 + i, f"common{i}", "xx") for i in range(60)] + [(9000, "seldom", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = langid.fit(docs, max_rows=41)
    names, model = fitted.names, fitted.table
    assert names == ["xx", "yy"]
    assert (model[1] > model[1].min()).sum() == len(set(langid.grams("seldom").tolist()))
    n = round(sum(np.exp(model[0] - model[0].min(), dtype=np.float64) - 1) / 2)  # grams counted
    assert 36 * 7 < n <= 40 * 8  # common and a number: 7 or 8 trigrams a document
    with pytest.raises(ValueError):
        langid.fit(docs, max_languages=1)


def test_licences(spark):
    rng = np.random.default_rng(13)
    rows = [(i, words(rng, 40) + "\n" + words(rng, 30)) for i in range(60)]
    rows += [(100, words(rng, 30) + "\nReleased under the MIT License.\n" + words(rng, 20)), (101, "Licensed under the Apache License, Version 2.0."), (102, None), (103, ""), (104, "Licensed under the Frobnicate License."), (104, "Licensed under the Frobnicate License.")]
    docs = docs_of(spark, rows).withColumn("best", F.lit(1))
    got = {r.doc_id: r for r in licences.scan(docs, licences.train(docs)).collect()}
    assert got[100].licences == ["mit"] and got[101].licences == ["apache-2.0"] and got[102].n_paragraphs == 1
    assert not got[104].licences and got[104].n_unknown == 1
    assert not any(got[i].licences or got[i].n_unknown for i in range(60))


def test_licences_in_wrapped_and_long_paragraphs(spark):
    rng = np.random.default_rng(16)
    rows = [(i, words(rng, 40) + "\n\n" + words(rng, 300)) for i in range(60)]
    mit, lgpl = licences.TEMPLATES["mit"][1], licences.TEMPLATES["lgpl"][0]
    rows += [(100, words(rng, 30) + "\n\n" + textwrap.fill(mit, 70) + "\n\n" + words(rng, 20)), (101, textwrap.fill(lgpl, 40)), (102, f"{words(rng, 10000)} {mit} {words(rng, 10000)}")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in licences.scan(docs, licences.train(docs)).collect()}
    assert got[100].licences == ["mit"] and got[100].n_paragraphs == 3 and got[100].n_confirmed == 1
    assert got[101].licences == ["lgpl"] and got[101].n_paragraphs == 1
    assert got[102].licences == ["mit"] and got[102].n_confirmed == 1
    assert not any(got[i].licences or got[i].n_unknown for i in range(60))


# ------------------------------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(14)
    shared = words(rng, 15)
    rows = [(d, words(rng, 60) + "\n" + (shared if d < 8 else words(rng, 15)), "a" if d % 2 else "b") for d in range(60)]
    rows += [(100 + i, rows[20][1] + f" extra{i}", "a") for i in range(3)] + [(200 + i, words(rng, 40) + " you utter numpty", "b") for i in range(30)]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, int(d >= 200)) for d, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids = []
    for name, stage in pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path)).cache()
        assert at.columns == pipeline.COLUMNS, name
        ids.append(sorted(r.doc_id for r in at.select("doc_id").collect()))
    assert {d for d in ids[0] if d < 200} == {d for d, *_ in rows if d < 200} and sum(d >= 200 for d in ids[0]) <= 2
    assert ids[1] == ids[0]
    assert [d for d in ids[0] if 100 <= d < 200] and not [d for d in ids[2] if 100 <= d < 200] and set(ids[2]) >= set(range(60))
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert packed and {r.doc_id for r in packed} <= set(ids[2])
    assert json.dumps([n for n, _ in pipeline.STAGES]) == '["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]'
