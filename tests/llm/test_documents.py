"""Operators on documents against brute force, on odd rows and on empty tables."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tallygrid.llm import decontamination, merkle, mixing, quality, simhash, tokens
from tallygrid.staging import Staging

from .fixtures import corpus, frame, row

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(d):
    return -(1 << 63) if d is None else d


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# --- decontamination


ITEMS = [
    (1, None), (2, ""), (3, "stone"), (4, "the of AND"), (4, "ok river"), (None, "ünder Ünder"),
    (5, "no id here"), (6, "x"), (7, "the the the the the the the of of of"),
]


def contaminated(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = word.findall((text or "").translate(LOW))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wanted[n][tuple(w[i : i + n])].add(item)
    out = Counter()
    for doc_id, text, *_ in rows:
        w = word.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n, windows in wanted.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out[key(doc_id), len(w), len(hit), len(ids), digest, bool(hit)] += 1
    return out


def test_decontamination_matches_brute_force(spark, docs):
    rows = corpus()
    items = ITEMS + [(10 + i, " ".join(rows[i][1].split(" ")[3:25])) for i in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontamination_table(docs, table, Staging(spark)).collect()
    found = Counter((key(r[0]), *r[1:]) for r in got)
    assert found == contaminated(rows, items)
    clean = decontamination.clean(docs, table, Staging(spark))
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for k, n in found.items() if not k[-1])


def test_decontamination_of_empty_tables(spark, docs, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontamination_table(none, items, Staging(spark)).count() == 0
    assert decontamination.decontamination_table(docs, items, Staging(spark)).where("contaminated").count() == 0


# --- SimHash


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(pairs, distance=4):
    values = sorted({f for _, f in pairs})
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    ids = defaultdict(list)
    for d, f in pairs:
        if d is not None:
            ids[find(f)].append(d)
    return {f: min(ids[find(f)], default=None) for f in values}


def test_simhash_matches_brute_force(spark, docs):
    pairs = [(r[0], simhash_of(r[1])) for r in corpus()]
    of = smallest(pairs)
    got = simhash.simhash_table(docs, Staging(spark)).collect()
    assert Counter(map(tuple, got)) == Counter((d, f"{f:016x}", of[f]) for d, f in pairs)
    kept = simhash.deduplicated(docs, Staging(spark))
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.collect()} == set(of.values())


@pytest.mark.parametrize("layouts", [(3,), (4,), (5,)])
def test_links_of_every_layout_and_in_blocks(spark, layouts):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    near = [centre ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for _ in range(150)]
    values = sorted({0, *near, *(int(x) for x in rng.integers(0, 1 << 63, 200))})
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    layout = simhash.plan_layout(prints, 4, layouts)
    assert sum(t + 1 for t in layout.thresholds) == 5
    assert sorted(b for bits in layout.bits for b in bits) == list(range(64))
    staging = Staging(spark)
    edges = simhash.links(prints, layout, staging, 4, block=32)
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(edges, staging).collect()}
    got = defaultdict(set)
    for v in values:
        got[roots.get(v, v)].add(v)
    want = defaultdict(set)
    for v, s in smallest([(v, v) for v in values]).items():
        want[s].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_allocation_is_the_cheapest():
    costs = np.array([[5.0, 6, 90], [1, 50, 99], [30, 31, 32]])
    assert simhash.allocate(costs, 3) == [1, 0, -1]
    assert simhash.allocate(costs, 1) == [-1, 0, -1]


# --- Merkle fingerprints


def test_merkle_matches_brute_force(spark, docs):
    rows = sorted((key(r[0]), (r[1] or "").encode()) for r in corpus())
    want = Counter()
    for i, (d, raw) in enumerate(rows):
        text, after = raw.decode(), rows[(i + 1) % len(rows)][1].decode()
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want[d, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = merkle.merkle_table(docs).collect()
    assert Counter((key(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
    texts = {key(r[0]): r[1] or "" for r in corpus() if r[0] is not None}
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    for a in texts:
        for b in texts:
            assert (texts[a] == texts[b]) == (prints[a] == prints[b])
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all((r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint) for r in got if r.n_chars)


def test_merkle_locates_an_edit(spark):
    lines = [f"Line {i}, with words, and more." for i in range(40)]
    changed = [*lines]
    changed[20] = "Something else."
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "a string, b string")
    df = merkle.fingerprinted(merkle.fingerprinted(df, "a", "fa"), "b", "fb")
    a, b = df.fa, df.fb
    near, first, leaves = df.select(
        merkle.likeness(a, b), merkle.first_difference(a, b), merkle.branch(a)
    ).first()
    assert 0.9 < near < 1
    assert first == next(i for i, x in enumerate(leaves) if i >= 20 * len(leaves) // 40)
    assert df.select(merkle.first_difference(a, a)).first()[0] is None


def test_merkle_keeps_full_digests_in_the_tree(spark, monkeypatch):
    texts = [("one, two. three\nfour",), ("one, two. three\nfive",), ("",), ("\n",)]
    df = spark.createDataFrame(texts, "a string")
    prints = [r[0] for r in merkle.fingerprinted(df, "a", "f").select("f").collect()]
    monkeypatch.setattr(merkle, "PIECE_DIGITS", 0)
    short = [r[0] for r in merkle.fingerprinted(df, "a", "f").select("f").collect()]
    assert [p.split(":")[0] for p in short] == [p.split(":")[0] for p in prints]
    assert len({p.split(":")[0] for p in short}) == 4


@pytest.mark.parametrize(
    "letters",
    ["".join(map(chr, range(0x4E00, 0x5E00))), "".join(map(chr, range(0x430, 0x450))) + "   ", "กขคงจฉชซณดตถทธนบปผฝพ", "x", "\U00020000"],
    ids=["han", "cyrillic", "thai", "one letter", "beyond the first plane"],
)
def test_merkle_likeness_in_any_script(spark, letters):
    rng = random.Random(8)
    a, b = ("".join(rng.choices(letters, k=6000)) for _ in range(2))
    edited = a[:3000] + b[:3000]
    df = spark.createDataFrame([(a, edited)], "a string, b string")
    whole = df.select(F.array_join(F.flatten(merkle.pieces(F.col("a"))), "") == df.a, merkle.pieces(F.col("a"))).first()
    assert whole[0] and all(0 < len(p) <= merkle.LONGEST for line in whole[1] for p in line)
    df = merkle.fingerprinted(merkle.fingerprinted(df, "a", "fa"), "b", "fb")
    assert df.select(merkle.likeness(df.fa, df.fb)).scalar() >= 0.3


def test_merkle_cuts_beyond_the_first_plane(spark):
    wide = "\U00020000"
    texts = [wide * 1025, "ab" + wide + "x" * 1200, "x" * 1200, "one two. " + wide * 600 + "\n" + wide, ""]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    sizes = {}
    for text, lines in df.select("a", merkle.pieces(F.col("a"))).collect():
        assert "".join(p for line in lines for p in line) == text
        sizes[text] = [[len(p) for p in line] for line in lines]
    assert [sizes[t] for t in texts] == [
        [[512, 512, 1]], [[512, 512, 179]], [[512, 512, 176]], [[9, 512, 89], [1]], [[0]],
    ]


def test_merkle_of_one_and_no_row(spark, none):
    assert merkle.merkle_table(none).count() == 0
    one = merkle.merkle_table(frame(spark, [row(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


# --- tokens


def test_tokens_match_the_library(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    at, want = 0, Counter()
    for d, raw in sorted((key(r[0]), (r[1] or "").encode()) for r in corpus()):
        ids = np.array(tokenizer.encode(raw.decode(), add_special_tokens=False).ids + [1], "<u4")
        want[d, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    got = tokens.token_table(docs, Staging(spark)).collect()
    assert Counter((key(r[0]), *r[1:]) for r in got) == want
    assert tokens.token_table(none, Staging(spark)).count() == 0


def test_short_cuts_give_the_ids_of_the_library(monkeypatch):
    import pyarrow as pa

    texts = [
        "", "\n", " \t\nTab\tword", "Σίσυφος ΟΔΟΣ ΟΔΟΣ.", "İstanbul İ. ı ſs ŉ ǅungla", "ªº ÀÉ×÷ß.",
        "<|endoftext|>x <|startoftext|>! a<|endoftext|>", "étude é! ̸ ≠ a≠", "don't DON'T. it's's '",
        "日本 語。 ﬁx 한국 하", "\x00a \x1f\xa0b　c", "9.5% a1! _x_ x_", "word" * 5000 + "... end",
        "a. A. a.. A! b?! B",
    ]
    tokenizer = tokens.Tokens(None)
    for held, size in ((1_000_000, 1 << 24), (3, 8), (0, 1)):
        monkeypatch.setattr(tokens, "REMEMBERED", max(1, held))
        got = []
        for part in tokens.pieces(pa.array(texts), size):
            ids, counts = tokenizer.ids(part)
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [tokenizer._encode([t])[0] for t in texts]
        tokenizer._forget()
        assert len(tokenizer._known) <= max(1, held)


def test_marks_are_looked_up_once_per_kind():
    import pyarrow as pa

    class Counting(tokens.Known):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    words = ["".join(w) for w in itertools.product("abcdefgh", repeat=3)]
    texts = pa.array([" ".join(w + m for w, m in zip(words, itertools.cycle([".", ",", "?!", ""])))])
    tokenizer = tokens.Tokens(None)
    tokenizer._known = Counting({"": 0})
    ids, counts = tokenizer.ids(texts)
    assert ids.tolist() == tokenizer._encode(texts.to_pylist())[0] and counts.tolist() == [len(ids)]
    assert tokenizer._known.asked <= len(words) + 3


def test_coder_keeps_its_format_in_little_memory():
    from tallygrid.llm import idcoder

    n = np.arange(1 << 18, dtype=np.uint64)
    ids = (n * n * np.uint64(2654435761) >> np.uint64(13)).astype(np.int64) % (1 << 16)
    ids[n % 3 > 0] %= 40
    lengths, order0 = idcoder.block_lengths(len(ids), 1024), idcoder.frequencies(ids)
    tracemalloc.start()
    blocks = idcoder.encode(ids, lengths, order0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert hashlib.sha256(b"".join(blocks)).hexdigest() == "7ffd7499327468dc7f8715fab102322a0b83385183241734e034ea4190f28583"
    assert (idcoder.decode(blocks, lengths, order0) == ids).all()
    assert peak <= 32 * len(ids)


def test_coder_carries_and_repeats():
    from tallygrid.llm import idcoder

    random = np.random.default_rng(3)
    for ids in (np.ones(4000, int), np.tile([5, 7, 9], 2000), random.zipf(1.3, 20000) % 50000, np.full(9, 65535)):
        lengths = idcoder.block_lengths(len(ids), 512)
        order0 = idcoder.frequencies(ids)
        assert order0.sum() == idcoder.IDS
        blocks = idcoder.encode(ids, lengths, order0)
        assert (idcoder.decode(blocks, lengths, order0) == ids).all()
    assert sum(map(len, idcoder.encode(np.ones(4000, int), [4000], idcoder.frequencies(np.ones(4000, int))))) < 400


def test_damage_is_noticed():
    data = tokens.pack([3, None], [2, 1], np.array([5, 1, 1]))
    names, lengths, ids = tokens.unpack(data)
    assert (names, lengths.tolist(), ids.tolist()) == ([3, None], [2, 1], [5, 1, 1])
    with pytest.raises(ValueError):
        tokens.unpack(data[:-1] + bytes([data[-1] ^ 1]))


# --- mixing


def test_mix_keeps_targets_and_limits(spark, none):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        source = ["a", "b", "c", "z", None][min(4, int(rng.integers(0, 9)))]
        rows.append(row(i, " ".join(["w"] * int(rng.integers(0, 60))), source))
    rows += [row(9000, "big " * 3000, None), row(5, None, "a"), row(None, "a b", "b"), row(None, "a b", "b")]
    df = frame(spark, rows)
    got = mixing.mixing_table(df, Staging(spark)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mixing_table(df.repartition(5), Staging(spark)).collect()))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len((r[1] or "").split())) for r in rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in got)
    weights = dict(zip(["a", "b", "c", "z", None], [5, 2, 1, 5, 2], strict=True))
    want, open_ones = {}, set(weights)
    while True:
        left = sum(sizes.values()) - sum(want.values())
        level = left / sum(weights[s] for s in open_ones)
        full = {s for s in open_ones if 3 * sizes[s] < level * weights[s]}
        if not full:
            break
        want |= {s: 3 * sizes[s] for s in full}
        open_ones -= full
    want |= {s: level * weights[s] for s in open_ones}
    for s in weights:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 60
    mixed = mixing.mixed(df, Staging(spark))
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mixing_table(none, Staging(spark)).count() == 0


def test_rounding_keeps_expected_copies(spark):
    df = frame(spark, [row(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(80)])
    total, runs = Counter(), 12
    for seed in range(runs):
        for r in mixing.mix(df, Staging(spark), weights=(3.0, 1.0), seed=1000 * seed, fan_in=8).collect():
            total[r.source] += r.copies
            assert r.copies in (0, 1, 2)
    for source, share in (("a", 1.5), ("b", 0.5)):
        assert total[source] / runs / 40 == pytest.approx(share, abs=0.12)


# --- quality


def test_quality_keeps_good_and_drops_bad(spark, none):
    rng = np.random.default_rng(9)
    good = [" ".join(rng.choice(["the", "stone", "lies", "by", "water", "and"], 40)) + "." for _ in range(300)]
    bad = [" ".join(w + "!!" for w in rng.choice(["BUY", "NOW", "FREE"], 40)) for _ in range(60)]
    rows = [row(i, t) for i, t in enumerate(good + bad)] + [row(None, None), row(999, "")]
    labels = spark.createDataFrame(
        [(i, int(i < 300), 0) for i in range(0, 360, 2)] + [(None, 1, None), (3, None, None)],
        "doc_id long, quality int, toxic int",
    )
    df = frame(spark, rows)
    kept = {r.doc_id for r in quality.kept(df, labels, Staging(spark)).collect()}
    assert set(range(300)) <= kept
    assert len(kept & set(range(300, 360))) < 25
    first = quality.resample(df, labels, Staging(spark))
    again = quality.resample(df.repartition(4), labels, Staging(spark))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert quality.resample(df, labels, Staging(spark), share=0.25).count() == round(0.25 * len(rows))
    assert quality.resample(df, labels.limit(0), Staging(spark)).count() == len(rows)
    assert quality.resample(none, labels, Staging(spark)).count() == 0


def test_quality_drops_toxic_and_keeps_clean(spark):
    rng = np.random.default_rng(10)
    rows, labels = [], []
    for i in range(1200):
        kind = "toxic" if i % 6 == 0 else "bad" if i % 6 == 1 else "clean"
        size = int(rng.choice([30, 100, 300]))
        if kind == "bad":
            words = [w + "!!" for w in rng.choice(["BUY", "NOW", "FREE"], size)]
        else:
            words = list(rng.choice([f"word{x}" for x in range(200)], size))
        if kind == "toxic":
            for at in rng.integers(0, size, 4):
                words[at] = str(rng.choice(["idiot", "moron", "vermin"]))
        rows.append(row(i, " ".join(words) + "."))
        if i % 12 < 8:
            labels.append((i, int(kind != "bad"), int(kind == "toxic")))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    clean = sum(q == 1 and not t for _, q, t in labels) / len(labels)
    assert clean < quality.good_share(table) < clean + 0.05
    got = {r.doc_id for r in quality.kept(frame(spark, rows), table, Staging(spark)).collect()}
    wanted, toxic = {i for i in range(1200) if i % 6 > 1}, set(range(0, 1200, 6))
    assert len(got & wanted) > 0.98 * len(wanted) * min(1, len(got) / len(wanted))
    assert len(got & toxic) < 0.3 * len(toxic)


def test_log_ratio_is_that_of_the_models(spark):
    df = frame(spark, [row(1, "a b"), row(2, "c c d")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    ratios = quality.log_ratios(df, labels)
    features = quality.Features()
    texts = {1: features.buckets("a b"), 2: features.buckets("c c d")}
    raw = np.bincount(np.concatenate(list(texts.values())), minlength=quality.BUCKETS) + 1.0
    target = np.bincount(texts[1], minlength=quality.BUCKETS) + 1.0
    assert ratios == pytest.approx(np.log(target / target.sum() * raw.sum() / raw))


def test_many_equal_rows_are_parted(spark):
    rows = [row(None, "a b c", "a")] * 3000 + [row(7, "d", "b")] * 40 + [row(i, "e f", "b") for i in range(300)]
    df = frame(spark, rows)
    staging = Staging(spark)
    got = mixing.mix(df, staging, fan_in=64).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(r[1].split())) for r in rows)
    taken = Counter()
    for r in got:
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3
    for source, target in {r.source: r.target for r in got}.items():
        assert abs(taken[source] - target) <= 3
    leaves = spark.read.parquet(next(p for p in staging._paths if "/leaves-" in p))
    assert leaves.select(F.max(F.size("docs"))).scalar() <= 130
    mixed = mixing.mixed(df, Staging(spark), fan_in=64)
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(
        {d: n for d in {r.doc_id for r in got} if (n := sum(r.copies for r in got if r.doc_id == d))}
    )
