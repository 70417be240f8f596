"""Fingerprints, the prefix trie and centroid clustering against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapair.llm import delta_lloyd, prefix_trie, scaled_sketch
from terrapair.llm import _text as T
from tests.llm import brute
from tests.llm.test_llm import corpus, frame, got


def test_edit_report_equals_brute_force(spark):
    docs = corpus()
    df = frame(spark, docs).repartition(5)
    out = got(scaled_sketch.edit_report(df, share=1.0), "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next", "jaccard_edited", "jaccard_next", "n_hashes")
    want = []
    for d, t, e, after in brute.edited(docs):
        a, b, c = brute.shingles(t), brute.shingles(e), brute.shingles(after)
        (ce, je), (cn, jn) = brute.contained(a, b), brute.contained(a, c)
        want.append((d, len(t), brute.sha(e), ce, cn, je, jn, len(a)))
    assert out == sorted(want, key=str)


@pytest.mark.parametrize("parts", ["1", "3"])
def test_edit_report_does_not_depend_on_ranges(spark, monkeypatch, parts):
    docs = corpus() + [(7, f"again {i}") for i in range(300)] + [(None, f"no id {i}") for i in range(50)]
    df = frame(spark, docs)
    one = got(scaled_sketch.edit_report(df), "doc_id", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    monkeypatch.setattr(scaled_sketch, "RANGES", 2)
    monkeypatch.setattr(T, "SLICE_BYTES", 3000)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert got(scaled_sketch.edit_report(df.repartition(7)), "doc_id", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r[1] for r in one] == [brute.sha(e) for _, _, e, _ in brute.edited(docs)] or sorted(r[1] for r in one) == sorted(brute.sha(e) for _, _, e, _ in brute.edited(docs))


def test_sketch_is_what_is_below_the_threshold():
    docs = corpus()
    texts = [(t or "").encode() for _, t in docs]
    full = scaled_sketch.sketches(*scaled_sketch._texts(texts), share=1.0)
    some = scaled_sketch.sketches(*scaled_sketch._texts(texts), share=0.1)
    for a, b, (_, t) in zip(full, some, docs):
        assert len(a) == len(brute.shingles(t or ""))
        below = a[a < int(0.1 * (1 << 48))]
        assert b.tolist() == (below if len(below) else a[:1]).tolist()


def test_estimates_follow_the_truth():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    a = [rng.choice(words) for _ in range(20_000)]
    for share in (0.25, 0.5, 0.9):
        b = a[: int(len(a) * share)]
        x, y = scaled_sketch.sketches(*scaled_sketch._texts([" ".join(a).encode(), " ".join(b).encode()]))
        assert abs(scaled_sketch.likeness(x, y)[0] - share) < 0.05 and scaled_sketch.likeness(y, x)[0] == 1.0


def test_merged_sketches_are_those_of_unions(spark):
    docs = [(d, t) for d, t in corpus() if d is not None and d not in (40,)]
    df = frame(spark, docs)
    rows = scaled_sketch.sketch_rows(df, share=0.1)
    groups = spark.createDataFrame([(d, d % 7) for d, _ in docs] + [(d, 100) for d, _ in docs], "id long, group long")
    out = scaled_sketch.merged(rows, groups, share=0.1).collect()
    full = dict(zip([d for d, _ in docs], scaled_sketch.sketches(*scaled_sketch._texts([(t or "").encode() for _, t in docs]), share=1.0)))
    for g in [*range(7), 100]:
        union = sorted({int(h) for d in full if g in (d % 7, 100) for h in full[d]})
        below = [h for h in union if h < int(0.1 * (1 << 48))]
        assert sorted(r["hash"] for r in out if r["id"] == g) == (below or union[:1])
    pairs = {(r["id"], r["other"]): r["containment"] for r in scaled_sketch.containment(rows, rows).collect()}
    assert pairs[(80, 81)] == 1.0 and (83, 84) not in pairs


def test_edit_report_of_few_documents(spark):
    df = frame(spark, [(1, "a")])
    assert scaled_sketch.edit_report(df.limit(0)).count() == 0
    one = scaled_sketch.edit_report(frame(spark, [(4, "abcdé")])).first()
    assert (one["n_chars"], one["edited_sha256"], one["near_next"]) == (5, brute.sha("abcab"), 1.0)
    blank = scaled_sketch.edit_report(frame(spark, [(4, None), (3, " ")])).collect()
    assert all(r["near_next"] == 1.0 and r["fingerprint"] == "" for r in blank)


CONVERSATION = "conv_id long, turn long, role string, text string, node long, depth int, name string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], CONVERSATION)


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(-30, 130), 1000, 2001]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "hello  there", "a b c", f"own {c}"])))
    rows += [(500, t, "user", f"turn {t % 3}") for t in range(70)] + [(501, t, "user", f"turn {t % 3}") for t in range(66)] + [(None, 1, "user", "nobody"), (7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, None, "same")]
    return rows


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def test_trie_equals_brute_force(spark, monkeypatch):
    rows = conversations()
    assert got(prefix_trie.prefix_trie(talks(spark, rows).repartition(6)), *TRIE) == brute.trie(rows)
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "IDS", 8)
    assert got(prefix_trie.prefix_trie(talks(spark, rows)), *TRIE) == brute.trie(rows)


def test_trie_of_the_conversations_as_they_are(spark):
    rows = conversations()
    assert got(prefix_trie.prefix_trie(talks(spark, rows), heads=1), *TRIE) == brute.trie(rows, heads=1)


def test_small_tries(spark):
    assert prefix_trie.prefix_trie(talks(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    for rows in ([(0, 1, "user", "a b")], [(6, 1, "user", "x")], [(None, 1, "u", "x")]):
        assert got(prefix_trie.prefix_trie(talks(spark, rows)), *TRIE) == brute.trie(rows)


def test_shared_turns_are_dealt_out(spark):
    """No shuffle of the naming rounds gathers a turn that all conversations share."""
    rows = [(c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(3000) for t in range(2)]
    out = prefix_trie.prefix_trie(talks(spark, rows), heads=1)
    assert {r["n_convs"] for r in out.where("depth < 2").collect()} == {3000} and out.count() == 3002


def vectors():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.4, 8)], "x", 1) for i in range(400)]
    rows += [(i, [1.0] * 8, "x", 1) for i in range(400, 700)] + [(900 + i, [0.5 * (i % 2)] * 8, "x", 1) for i in range(6)]
    rows += [(800, None, "x", 1), (801, [1.0] * 7, "x", 1), (802, [1.0] * 7 + [None], "x", 1), (803, [1.0] * 7 + [float("nan")], "x", 1), (804, [float("inf")] * 8, "x", 1), (805, [3e9] * 8, "x", 1)]
    return [*rows, (None, [2.0] * 8, "x", 1), (None, [-2.0] * 8, "x", 1), (3, [-1.7] * 8, "x", 1), (806, [], "x", 1)]


VECTORS = "vec_id long, embedding array<double>, q string, cluster int"
CLUSTERS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("k,rounds", [(7, 3), (16, 8), (3, 0), (2000, 2)])
def test_clusters_equal_plain_rounds(spark, k, rounds):
    rows = vectors() if k < 2000 else vectors()[:60]
    df = spark.createDataFrame(rows, VECTORS)
    out = delta_lloyd.clusters(df.repartition(5), k=k, rounds=rounds, dims=8)
    assert got(out, *CLUSTERS) == brute.clusters([r[:2] for r in rows], k, rounds, 8)


def test_clusters_of_large_components(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-2e6, 2e6) for _ in range(8)], "x", 1) for i in range(60)]
    out = delta_lloyd.clusters(spark.createDataFrame(rows, VECTORS), k=4, dims=8)
    assert got(out, *CLUSTERS) == brute.clusters([r[:2] for r in rows], 4, 3, 8)


def test_no_vectors(spark):
    df = spark.createDataFrame(vectors(), VECTORS)
    assert delta_lloyd.clusters(df.limit(0), dims=8).count() == 0 == delta_lloyd.clusters(df.where("vec_id = 803"), dims=8).count()


def test_only_moved_vectors_are_transferred(spark):
    """Transfers of a round are those of vectors whose owner changed."""
    state = spark.createDataFrame([(1, [1, 2], 0, 5, 0), (2, [3, 4], 1, 5, 0), (3, [5, 6], 1, 5, -1)], delta_lloyd._STATE)
    out = {r["cluster"]: tuple(r)[1:] for r in delta_lloyd.transfers(state, 2).collect()}
    assert out == {0: (-1, -3, -4), 1: (2, 8, 10)}


def test_secrets_of_very_long_runs():
    """Ten million characters of one run take seconds, whatever looks like a header in it."""
    import time

    from terrapair.llm import secrets

    rng = random.Random(2)
    letters = "".join(rng.choices("eICDabcxyzJhbGciOiJ", k=4_000_000))
    for run in (letters, "ICAg" * 500_000, "eyJhbGci" * 250_000, "b3BlbnNzaC1rZXktdjEA" * 100_000, "eyI6" * 50_000):
        began = time.time()
        base, added = secrets.scan(f"{run}.abcd.efgh".encode())
        assert not added and time.time() - began < 20
    token = "eyJhbGciOiJIUzI1NiJ9.e30.c2ln"
    at = len("ICAg" * 1000)
    assert secrets.scan(("ICAg" * 1000 + token).encode())[1] == [(0, at + len(token), "signed")]
    assert secrets.scan((letters[:4000] + token).encode())[1][-1][1] == 4000 + len(token)


def test_token_counts_of_few_and_long_words(monkeypatch):
    import time

    from terrapair.llm import token_counts
    from terrapair.llm.queries import tokenizer_path

    model, rng = token_counts.Unigram(tokenizer_path("piece_bpe_32k.model")), random.Random(6)
    words = ["".join(rng.choices("abcthe漢字é", k=rng.randint(1, 700))) for _ in range(30)]
    words += [w + "xx" for w in words] + [w[:50] for w in words]
    want = [model.count_one(w) for w in words]
    for few in (0, 16, 1 << 30):
        monkeypatch.setattr(token_counts, "FEW", few)
        assert list(model.counts(words)) == want
    monkeypatch.undo()
    began = time.time()
    model.counts(["".join(rng.choices("abcthe漢字é", k=200_000))])
    assert time.time() - began < 10


def test_texts_without_labels_stay(spark):
    from terrapair.llm import language_id

    df = frame(spark, [(1, "some text"), (2, "some text"), (3, "123"), (4, None)], lang=None)
    assert got(language_id.keep_identified(df), "doc_id") == [(1,), (2,)]
