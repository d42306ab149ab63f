"""Shards, mix, fingerprints, near-duplicates, language model and pipeline against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelwright.llm import fingerprints, katz, mixing, neardup, sharding
from panelwright.llm.catalog import QUERIES
from panelwright.llm.common import cut, numbered

DIR = "/root/testdata/sf0.001"


# --- shards ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 64, 1000, 1025])
def test_permutation(n):
    rows = np.arange(n)
    places = sharding.permute(rows, n, 3)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permute(places, n, 3, inverse=True).tolist() == rows.tolist()


def test_shards_query(spark, texts):
    rows = QUERIES["op7_feistel_shards"](spark, DIR).collect()
    assert len(rows) == len(texts)
    text = dict(texts)
    slots = defaultdict(list)
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = sorted(rows, key=lambda r: r["doc_id"])
    places = sharding.permute(np.arange(len(rows)), len(rows), 7)
    assert [r["shard"] + 24 * r["slot"] for r in order] == places.tolist()


def test_numbers_and_shards_of_frames(spark, odd, empty):
    rows, n = numbered(odd.select("doc_id", "text"), "doc_id", "text")
    assert n == odd.count() and sorted(r["row_no"] for r in rows.collect()) == list(range(n))
    placed = sharding.assign(odd.withColumnRenamed("source", "shard"), "doc_id", "text", shards=4)
    assert Counter(r["shard"] for r in placed.collect()) == Counter(k % 4 for k in range(n))
    assert sharding.assign(empty, "doc_id", shards=4).collect() == []


def test_written_shards(spark, documents, tmp_path):
    placed = sharding.assign(documents.select("doc_id"), "doc_id", shards=3)
    sharding.write_shards(placed, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 3


# --- mix ------------------------------------------------------------------------------------------


def plain_targets(sizes):
    """Shares by weight 1, 2, 3; a source stops at three times its size; the excess is shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_weight = sum(w for s, w in weight.items() if s not in fixed)
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / open_weight for s in order if s not in fixed} if open_weight else {}
        over = [s for s, x in share.items() if x >= 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def check_mix(rows, source_of):
    sizes, got = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[source_of(r)] += r["size"]
        got[source_of(r)] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = plain_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[source_of(r)] and math.isclose(r["target"], want[source_of(r)], rel_tol=1e-9, abs_tol=1e-6)
    for s, t in want.items():
        assert abs(got[s] - t) <= 1
    return want


def test_mix_query(spark, documents):
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    rows = QUERIES["op10_low_discrepancy_mix"](spark, DIR).collect()
    assert len(rows) == len(source)
    check_mix(rows, lambda r: source[r["doc_id"]])
    again = QUERIES["op10_low_discrepancy_mix"](spark, DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_with_small_and_hot_sources(spark):
    """Sources that stop at three times their size, a hot source, ties, null source, documents without words."""
    rng = random.Random(4)
    rows = [(k, " ".join("w" for _ in range(rng.randrange(40))), "hot") for k in range(900)]
    rows += [(1000, "a b c", "tiny"), (1001, None, "void"), (1002, "one two", None), (1003, "one two", None), (1003, "one two", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = cut(mixing.numbered_rows(df))
    sized = cut(mixing.sizes(kept, keep=("source",)))
    plan = mixing.plan_mix(sized, block_words=64).join(sized.select("_rid", "source"), "_rid").collect()
    assert len(plan) == len(rows)
    check_mix(plan, lambda r: r["source"])


def test_schedule_is_even(spark):
    """Every prefix of the mix holds nearly the target shares."""
    df = spark.createDataFrame([("0a", 60000, 10, 30000.0), ("0b", 60000, 10, 60000.0)], "_key string, source_size long, docs long, target double")
    slots = sorted((r["slot"], r["_key"], r["rank"]) for r in mixing.schedule(df, 100).collect())
    assert Counter(k for _, k, _ in slots) == {"0a": 300, "0b": 600}
    seen = Counter()
    for n, (_, key, rank) in enumerate(slots, 1):
        assert rank == seen[key]
        seen[key] += 1
        assert abs(seen["0a"] - n / 3) <= 6


def test_mixed_rows(spark, odd, empty):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    sized = cut(mixing.sizes(cut(mixing.numbered_rows(odd)), keep=("text",)))
    plan = mixing.plan_mix(sized).join(sized.select("_rid", "text"), "_rid").collect()
    want = Counter()
    for r in plan:
        if r["taken"]:
            want[r["text"]] += -(-r["taken"] // r["size"])
    # every copy is the whole text, white space included
    assert Counter(r["text"] for r in out.collect()) == want and any(r["taken"] % r["size"] for r in plan if r["size"])
    assert mixing.mixed(empty).collect() == []


# --- fingerprints ---------------------------------------------------------------------------------


def likeness(a, b):
    cells = [{x[k : k + 8] for k in range(0, len(x), 8)} for x in (a, b)]
    bins = [{int(c, 16) >> fingerprints.CELL_BITS for c in s} for s in cells]
    return len(cells[0] & cells[1]) / len(bins[0] | bins[1]) if bins[0] | bins[1] else 1.0


def test_fingerprint_query(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op6_order_minhash"](spark, DIR).collect()}
    assert len(got) == len(texts)
    by_text, closer = {}, 0
    for k, (i, t) in enumerate(texts):
        r, after = got[i], texts[(k + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 4] + after[1][: len(t) // 4]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert math.isclose(r["near_edited"], likeness(r["fingerprint"], r["edited_fingerprint"]))
        assert math.isclose(r["near_next"], likeness(r["fingerprint"], got[after[0]]["fingerprint"]))
        closer += r["near_edited"] > r["near_next"]
    assert closer >= 0.95 * len(texts)


def prints(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, text string")
    return [r["fingerprint"] for r in fingerprints.fingerprints(df).orderBy("k").collect()]


def test_fingerprints_by_hand(spark):
    """Occurrence numbers: 'a b' repeated is more than 'a b' once, in each cell's k-mers."""
    rng = random.Random(8)
    base = [rng.choice(["red", "green", "blue", "one", "two", "six", "ten"]) + str(rng.randrange(60)) for _ in range(400)]
    swapped = base[200:] + base[:200]
    few = [x if rng.random() > 0.02 else "new" for x in base]
    a, b, c, d, e, f = prints(spark, [" ".join(base), " ".join(few), " ".join(swapped), "x y", "x y x y x y", "x y x y"])
    assert likeness(a, b) > 0.75 and likeness(a, b) > likeness(a, c) and len({d, e, f}) == 3
    one, two, blank, null = prints(spark, ["solo", "other", "  \n", None])
    assert one != two and len(one) == 8 and blank == null == ""


def test_fingerprint_frames(spark, odd, empty):
    rows = fingerprints.edited_against_next(odd).collect()
    assert len(rows) == odd.count()
    same = [r for r in rows if r["doc_id"] == 6]
    assert len(same) == 2 and same[0]["fingerprint"] == same[1]["fingerprint"] and all(0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.edited_against_next(empty).collect() == [] and len(fingerprints.fingerprints(odd).collect()) == odd.count()
    alone = fingerprints.edited_against_next(odd.where("doc_id = 5")).first()
    assert alone["near_next"] == 1.0


# --- near-duplicates ------------------------------------------------------------------------------


def plain_components(rows, width, percent):
    """{id: (set size, least id reachable)} by all pairs."""

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))) if w else frozenset()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_neardup_query(spark, texts):
    want = plain_components(texts, 3, 85)
    rows = QUERIES["op9_setsketch_neardup"](spark, DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
    return words


def test_neardup_groups_and_chains(spark):
    """Exact copies, a group around one text, chains in which ends are not alike, and near misses."""
    rng = random.Random(11)
    rows, k = [], 100
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    for _ in range(120):
        rows.append((k := k + 1, " ".join(edited(rng, base, 3))))
    chain = [f"c{rng.randrange(10**6)}" for _ in range(200)]
    for _ in range(25):
        rows.append((k := k + 1, " ".join(chain)))
        chain = edited(rng, chain, 4)
    for _ in range(30):
        rows.append((k := k + 1, " ".join(edited(rng, base, 9))))
    rows += [(k + j, " ".join(base)) for j in range(1, 40)] + [(5, "a b"), (6, "A  b"), (7, "a"), (8, None), (9, " ")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()}
    assert got == plain_components(rows, 3, 85)


def test_neardup_ids_with_several_texts(spark):
    rng = random.Random(4)
    a, b = ([f"{x}{rng.randrange(10**6)}" for _ in range(80)] for x in "ab")
    near = lambda words: " ".join([*words[:-1], "changed"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (4, "x y z"), (4, "x y z")]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    with pytest.raises(TypeError):
        neardup.near_duplicates(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_joint_likelihood():
    """The estimate follows the true similarity."""
    rng = np.random.default_rng(1)
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        n, errors = 3000, []
        for _ in range(5):
            common = rng.integers(1, 2**63, int(n * share), dtype=np.uint64)
            a, b = (np.concatenate([common, rng.integers(1, 2**63, n - len(common), dtype=np.uint64)]) for _ in "ab")
            x, y = neardup.registers(a), neardup.registers(b)
            est = neardup.joint_similarity(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([float(n)]), np.array([float(n)]))[0]
            errors.append(est - len(common) / (2 * n - len(common)))
        assert abs(np.mean(errors)) < 0.06
    a, b = rng.integers(1, 2**63, 500, dtype=np.uint64), rng.integers(1, 2**63, 700, dtype=np.uint64)
    merged = np.maximum(neardup.registers(a), neardup.registers(b))
    assert (merged == neardup.registers(np.concatenate([a, b]))).all()


def test_memory_goes_back_after_the_last_batch(monkeypatch):
    """What a task's function holds is let go of before memory is given back, and it works on no batch at all."""
    import weakref

    from panelwright.llm import common

    class Batch:
        pass

    seen, alive = [], []
    monkeypatch.setattr(common, "given_back", lambda: alive.append([r() is not None for r in seen]))

    def work(parts):
        for batch in parts:
            seen.append(weakref.ref(batch))
            yield len(seen)

    assert list(common.tidy(work)(Batch() for _ in range(3))) == [1, 2, 3] and alive == [[False] * 3]
    assert list(common.tidy(work)(iter([]))) == [] and len(alive) == 2


def test_neardup_frames(odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    of = {r["doc_id"]: r for r in rows}
    assert of[6]["component_id"] == 5 and not of[6]["kept"] and of[1]["component_id"] == 1 and of[1]["n_shingles"] == 0 and of[None]["kept"]
    assert neardup.near_duplicates(empty).collect() == []


# --- language model -------------------------------------------------------------------------------


def plain_katz(texts):
    """The model over dictionaries, after the docstring."""

    def tokens(t):
        return [*(t or "").encode().lower().split(), None]

    train = [tokens(t) for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    uni = Counter(w for t in train for w in t)
    n = sum(uni.values())
    pairs = Counter((h, w) for t in train for h, w in zip(["<s>", *t], t))
    context = Counter(uni) + Counter({"<s>": len(train)})
    d = lambda counts: katz.discounts(Counter(counts.values()))
    d1, d2 = d(uni), d(pairs)
    disc = lambda r, x: r * (x[r] if r <= katz.K else 1.0)
    mass = sum(disc(r, d1) for r in uni.values())
    unknown = max(1 - mass / n, 1 / (n + 1))
    s1 = (1 - unknown) * n / mass
    p = lambda w: disc(uni[w], d1) / n * s1 if w in uni else unknown
    alpha, s2 = {}, {}
    after = defaultdict(list)
    for h, w in pairs:
        after[h].append(w)
    for h, seen in after.items():
        m = sum(disc(pairs[h, w], d2) for w in seen)
        left = max(1 - m / context[h], 1 / (context[h] + 1))
        s2[h], alpha[h] = (1 - left) * context[h] / m, left / (1 - sum(map(p, seen)))

    def prob(h, w):
        if (h, w) in pairs:
            return disc(pairs[h, w], d2) / context[h] * s2[h]
        return alpha.get(h, 1.0) * p(w)

    return tokens, uni, n, prob, unknown


def test_katz_query(spark, texts):
    tokens, uni, n, prob, unknown = plain_katz(texts)
    rows = QUERIES["op8_katz_backoff"](spark, DIR).collect()
    assert len(rows) == len(texts)
    text, better = dict(texts), []
    for r in rows:
        t = tokens(text[r["doc_id"]])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in uni for w in t), n)
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (len(uni) + 1))) for w in t)
        score = sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t], t))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
        if r["held_out"]:
            better.append(r["score"] - r["base_score"])
    assert sum(better) > 0


def test_katz_adds_up_to_one(spark, texts):
    _, uni, _, prob, unknown = plain_katz(texts)
    for h in ["<s>", *[w for w, _ in uni.most_common(8)], min(uni, key=lambda w: (uni[w], str(w))), b"never seen"]:
        if h is not None:
            assert math.isclose(sum(prob(h, w) for w in [*uni, b"never seen"]), 1.0, rel_tol=1e-9)


@pytest.mark.parametrize("share", [1 / 300, 2.0])
def test_katz_rare_words(spark, documents, texts, monkeypatch, share):
    """A higher share for the words that travel sends more tokens the way of rare ones."""
    monkeypatch.setattr(katz, "SHARED", share)
    monkeypatch.setattr(katz, "SLICE", 20_000)
    tokens, uni, n, prob, _ = plain_katz(texts)
    text = dict(texts)
    model = katz.Katz(documents)
    assert len(model.words.counts) <= 302
    for r in model.scores(documents).collect():
        t = tokens(text[r["doc_id"]])
        assert math.isclose(r["score"], sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t], t)), rel_tol=1e-9)


def test_katz_counts_every_pair(spark):
    """Pairs of words below any share of the corpus count; scores are those of the uncut model."""
    filler = " ".join(f"w{k}" for k in range(50)) + " " + "the " * 60_000
    texts = [(k, "Rare couple meets the rare couple again") for k in range(12)] + [(20 + k, f"{filler} x{k}") for k in range(3)]
    tokens, uni, n, prob, _ = plain_katz(texts)
    assert uni[b"w7"] < n / 20_000 and not any(zlib.crc32(str(k).encode()) % 10 == 0 for k in (0, 20))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = katz.Katz(docs)
    assert sum(int(katz._opened(r["blob"])[1].sum()) for r in model.pairs.collect()) == len({(h, w) for i, t in texts if zlib.crc32(str(i).encode()) % 10 for h, w in zip(["<s>", *tokens(t)], tokens(t))})
    for r in model.scores(docs).collect():
        t = tokens(dict(texts)[r["doc_id"]])
        assert math.isclose(r["score"], sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *t], t)), rel_tol=1e-9)


def test_good_turing_discounts():
    d = katz.discounts({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75})
    assert all(0 < x < 1 for x in d[1:]) and list(d[1:]) == sorted(d[1:])
    assert katz.discounts({})[1] == 0.5 and katz.discounts({1: 4, 2: 3})[1] == pytest.approx(0.6)


def test_katz_frames(odd, empty):
    rows = katz.Katz(odd).scores(odd).collect()
    assert len(rows) == odd.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert katz.Katz(empty).scores(empty).collect() == []
    assert [r["score"] for r in katz.Katz(empty).scores(odd).where("doc_id = 5").collect()] == [0.0]


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark, documents):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        out = cut(stage(spark, docs, DIR))
        if name != "bpe":
            assert out.columns == documents.columns
        seen[name], docs = (docs, out), out
    before, after = (x.select("doc_id", "text").collect() for x in seen["near_dedup"])
    want = plain_components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert {r["doc_id"] for r in after} == {i for i, (_, c) in want.items() if i == c}
    before, after = (x.count() for x in seen["quality_rules"])
    assert after < before
    before, after = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in seen["pii"])
    assert before == after
    before, after = (x.select("doc_id", "text", "source").collect() for x in seen["mix"])
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(r["text"].encode().split())
    got = Counter()
    for r in after:
        got[r["source"]] += len(r["text"].encode().split())
    # the edge document of a source is taken whole
    longest = {s: max(len(r["text"].encode().split()) for r in before if r["source"] == s) for s in sizes}
    for s, t in plain_targets(sizes).items():
        assert -1 <= got[s] - t <= longest[s]
    coded = seen["bpe"][1].collect()
    assert len(coded) == len(after) and all(r["round_trip"] for r in coded)
    whole = corpus_pipeline.run(spark, DIR).collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in whole) == sorted((r["doc_id"], r["ids_sha256"]) for r in coded)


def test_pipeline_stages_on_odd_rows(spark, odd, empty):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DIR).count() == 0
        stage(spark, odd, DIR).collect()
