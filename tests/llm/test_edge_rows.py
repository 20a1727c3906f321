"""Every operator on odd rows: nulls, empty and very long texts, ties, repeated
rows, empty tables, and extra columns with clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from titlematch.llm import exact_dedup, mixing, near_dedup, packing, quality, secrets, token_counts, topk_search, toxicity, training_order
from titlematch.llm.tokens import default_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, node string, score string, _row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "日本", "a!", "don't"]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))
        rows.append([i, text, f"s{i % 4}"])
    rows += [[60, rows[3][1].upper(), "s0"], [61, rows[3][1], "s1"], [62, rows[10][1] + " tail", "s2"]]
    rows += [[63, None, None], [64, "", "s1"], [65, " \n\t ", "s1"], [None, "lonely words here", "s2"], [None, None, None]]
    rows += [[66, "again and again", "s3"]] * 3 + [[67, "again and again", None]]
    rows += [[68, " ".join(f"long{i % 977}" for i in range(60_000)), "s0"], [69, "x" * 200_000, "s0"], [70, "one", "s9"]]
    return [(i, t, "en", s, -1, 7, "f", "n", "s", "r") for i, t, s in rows]


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def key(row):
    return tuple("~" if x is None else str(x) for x in row)


def test_exact_groups(docs, rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(fold(t), []).append(i)
    want = []
    for i, t, *_ in rows:
        own = groups[fold(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(fold(t).encode()).hexdigest()))
    got = exact_dedup.exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_without_copies(docs, rows):
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns
    got = [fold(r.text) for r in kept.collect()]
    assert sorted(got) == sorted({fold(t) for _, t, *_ in rows})


def shingles(text, words):
    w = WORD.findall(fold(text))
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def classes(rows, words):
    ids = [(i, shingles(t, words)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(ids):
        for j, t in ids[:a]:
            both = len(s & t)
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(shingles(t, words)), root(i) if i is not None else None, i is None or root(i) == i) for i, t, *_ in rows]


@pytest.mark.parametrize("words", [2, 5])
def test_near_classes(docs, rows, words):
    got = near_dedup.near_classes(docs, words).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(key, got)) == sorted(map(key, classes(rows, words)))


def test_near_classes_of_a_loose_group(spark):
    """Copies of one text, each with other edits: most pairs are below 0.8, some
    above, and all share bands; blocks are small enough to be several."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([1, 3, 8, 12, 16])):
            words[k] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    block, near_dedup.BLOCK = near_dedup.BLOCK, 16
    try:
        got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    finally:
        near_dedup.BLOCK = block
    assert sorted(map(key, got)) == sorted(map(key, classes(rows, 2)))


def test_near_copies_go(docs, rows):
    kept = near_dedup.without_near_copies(docs, 2)
    assert kept.columns == docs.columns
    assert sorted(key([r.doc_id]) for r in kept.collect()) == sorted(key([i]) for i, _, _, k in classes(rows, 2) if k)


def test_mix(docs, rows):
    sizes = {}
    for _, t, _, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, fixed = {}, set()
    while True:  # share what is left by weight; stop targets at three times the size
        left = sum(sizes.values()) - sum(target[s] for s in fixed)
        target |= {s: left * weight[s] / sum(weight[x] for x in order if x not in fixed) for s in order if s not in fixed}
        over = [s for s in order if s not in fixed and target[s] > 3 * sizes[s]]
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        fixed |= set(over)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in order:
        largest = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - target[s]) <= max(largest, 9)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in got)


def test_token_counts(docs, rows):
    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t, *_ in rows]
    assert sorted(map(key, token_counts.token_counts(docs).collect())) == sorted(map(key, want))


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (500, 40)])
def test_token_counts_of_spliced_chunks(spark, chunk, overlap):
    rng, library = random.Random(chunk), Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    words = ["a", "bc", " ", "  ", "\n", "\xa0", "é", "日本", "!!", "<|endoftext|>", "don't", "x" * 120, "'"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "", "\n\n"]) for _ in range(n)) for n in (40, 300, 900, 1500)]
    texts += ["q" * 3000, " " * 3000, "ab " * 40 + "z" * 900 + " cd" * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, chunk=chunk, overlap=overlap).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def _pieces(rows, size, kind):
    library = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), size):
            part = ids[k : k + size]
            yield i, k // size, k, len(part), zlib.crc32(np.array(part, kind).tobytes())


def test_packing(docs, rows):
    got = packing.packed(docs).collect()
    assert sorted(key(r[:5]) for r in got) == sorted(map(key, _pieces(rows, 2048, "<u4")))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 2


def test_best_fit_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(50):
        capacity = rng.choice([7, 30, 100])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 200))), reverse=True)
        counts = {x: items.count(x) for x in items}
        segments = packing.best_fit(counts, capacity)
        used = {}
        for length, _, n, first, offset in segments:
            for s in range(first, first + n):
                assert used.get(s, 0) == offset
                used[s] = offset + length
        assert max(used.values()) <= capacity and sum(n for _, _, n, _, _ in segments) == len(items)
        gaps = []  # row by row
        for x in items:
            fits = [g for g in gaps if g >= x]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - x)
            else:
                gaps.append(capacity - x)
        assert sorted(gaps) == sorted(capacity - u for u in used.values())


def test_training_order(spark, docs, tmp_path):
    library = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    path, sequence, shard = str(tmp_path / "order"), 64, 50
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    n = training_order.materialise(docs, path, sequence=sequence, shard=shard)
    got = {r.slot: r for r in training_order.read_order(spark, path, 0, sequence, shard).collect()}
    assert sorted(got) == list(range(n))
    # undo the permutation: the sequences in order are the documents' ids in order
    stream, at = [], []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        at += [(r.doc_id, k) for k in range(len(ids))]
        stream += ids
    read = []
    for slot in training_order.permuted(np.arange(n), n):
        r = got[int(slot)]
        assert (r.doc_id, r.start) == at[len(read)] and 0 < r.length <= sequence
        assert (r.shard, r.byte_offset) == (r.slot // shard, r.slot % shard * training_order.stride(sequence))
        read += np.frombuffer(r.ids, "<u2").tolist()
    assert read == stream
    assert sum(r.length < sequence for r in got.values()) <= docs.rdd.getNumPartitions()


def test_training_order_resumes(spark, docs, tmp_path):
    path = str(tmp_path / "order")
    n = training_order.materialise(docs, path, sequence=64, shard=50)
    every = {r.slot: r for r in training_order.read_order(spark, path, 0, 64, 50).collect()}
    assert sorted(every) == list(range(n))
    rest = training_order.read_order(spark, path, 77, 64, 50).collect()
    assert {r.slot: r for r in rest} == {s: r for s, r in every.items() if s >= 77}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(n):
    assert sorted(training_order.permuted(np.arange(n), n).tolist()) == list(range(n))
    if n > 60:
        assert (training_order.permuted(np.arange(n), n, 1) != training_order.permuted(np.arange(n), n, 2)).any()


def test_secrets(spark):
    access, weak, far = "AKIA" + "B2" * 8, "aB3/" * 10, " filler" * 200
    texts = [
        f"id {access} and {weak} at https://h.example/x?y=1",
        f"only {weak} at https://h.example/",
        f"{access} alone, see https://h.example/",
        f"{access}{far} {weak}",
        f"{access} token: 'abcdefgh1' http://h.example end",
        f"Ünï😀 PassWord = \"a.b-c_d+e\" {'ab01' * 9} API_KEY=short key secret=token: abcdefghij AKIA1234",
        f"{access} {weak} {access}" + f" {weak}" * 3,
        None,
        "",
    ]
    got = {r.doc_id: r for r in secrets.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}

    def listed(i):
        return [(s.split(":")[0], texts[i][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in got[i].spans.split(",") if s]

    assert listed(0) == [("access", access), ("secret", weak), ("endpoint", "https://h.example/x?y=1")]
    assert listed(1) == []
    assert listed(2) == [("access", access)]
    assert listed(3) == [("access", access)]
    assert listed(4) == [("access", access), ("assign", "token: 'abcdefgh1"), ("endpoint", "http://h.example")]
    assert listed(5) == [("assign", 'PassWord = "a.b-c_d+e'), ("hex", "ab01" * 9)]
    assert [k for k, _ in listed(6)] == ["access", "secret", "access", "secret", "secret", "secret"]
    assert listed(7) == listed(8) == []
    assert got[8].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (got[5].n_assign, got[5].n_access, got[5].n_hex) == (1, 0, 1)


def test_secrets_in_assignments_without_a_space(spark):
    access, weak = "AKIA" + "C3" * 8, "aB3/" * 10
    texts = [
        f"aws_access_key_id={access}\naws_secret_access_key={weak}\nurl=https://h.example/x",
        f"AccessKeyId={access};SecretAccessKey={weak};https://h.example/y",
        f"{access} key={weak}= https://h.example/z",
        f"{access} key={weak}c https://h.example/z",
    ]
    got = {r.doc_id: r.spans for r in secrets.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    listed = [[(s.split(":")[0], t[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in got[i].split(",")] for i, t in enumerate(texts)]
    for own, path in zip(listed[:3], "xyz", strict=True):
        assert own == [("access", access), ("secret", weak), ("endpoint", f"https://h.example/{path}")]
    assert listed[3] == [("access", access)]


def test_scores(docs, labels, rows):
    for scored in (quality.quality_scores(docs, labels), toxicity.toxicity(docs, labels)):
        got = scored.collect()
        assert sorted(key([r.doc_id]) for r in got) == sorted(key([r[0]]) for r in rows)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_scores_without_labels(docs, labels):
    nothing = labels.filter("doc_id < 0")
    assert quality.quality_scores(docs, nothing).filter("score <> 0.5").count() == 0
    assert toxicity.toxicity(docs, nothing).filter("score <> 0.5").count() == 0


def test_search(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(800, None), (None, rows[0][1]), (900, [1.0, None]), (901, [float("nan")] * 6)]
    rows += [(902, [1.0, float("inf")]), (903, [1.0, 2.0]), (300, rows[300][1]), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", F.lit(1).alias("place"), F.lit(2).alias("block"))
    valid = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for a, (i, q) in enumerate(valid):
        if i % 100 == 0:
            found = sorted((-int(sum(x * y for x, y in zip(q, v, strict=False))), j) for b, (j, v) in enumerate(valid) if a != b)[:10]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    got = [tuple(r) for r in topk_search.top_scores(df).collect()]
    assert sorted(got) == sorted(want)
    few = topk_search.top_scores(df.filter("vec_id < 5")).collect()
    assert len(few) == 4
    assert topk_search.top_scores(df.filter("vec_id < 0")).count() == 0


def test_empty_tables(none, labels):
    frames = [
        exact_dedup.exact_groups(none),
        exact_dedup.without_copies(none),
        near_dedup.near_classes(none),
        near_dedup.without_near_copies(none),
        mixing.mix(none),
        mixing.mixed_documents(none),
        token_counts.token_counts(none),
        packing.packed(none),
        training_order.training_order(none),
        secrets.secrets(none),
        quality.quality_scores(none, labels),
        quality.accepted(none, labels),
        toxicity.toxicity(none, labels),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_quotient_filters_merge_losslessly():
    from titlematch.llm.quotient import QuotientFilter

    rng = np.random.default_rng(0)
    parts = [rng.integers(0, 5000, n, dtype=np.uint64) * np.uint64(0x3F4A7C15) % np.uint64(1 << 40) for n in (0, 1, 700, 3000)]
    merged = QuotientFilter.merge(QuotientFilter.from_bytes(QuotientFilter.build(10, 30, p).to_bytes()) for p in parts)
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert (merged.keys == keys).all() and (merged.counts == counts).all()
