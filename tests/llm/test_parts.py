"""The pieces of the operators against plain versions."""

import math
import pickle
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import decontamination, lm_scoring, near_dedup, packing, pii, pieces, quality
from broadsheet.llm import secrets, sharding, spans, token_counts
from broadsheet.llm.tagger import Tagger, char_ids


def test_hilbert_neighbours_touch():
    side = 8
    grid = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = packing.hilbert_keys(grid, bits=3)
    assert sorted(keys) == list(range(side**3))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("lengths", [[5], [2048], [2049, 1], [1, 1, 1], [700, 3000, 41]])
def test_packer_fills_sequences(lengths):
    packer = packing._Packer(2048, 0)
    rows = []
    for k, n in enumerate(lengths):
        rows += packer.add(k, np.arange(n, dtype="<u4").tobytes())
    rows += packer.finish()
    sizes = Counter()
    for _, _, n, _, _, sequence, _ in rows:
        sizes[sequence] += n
    assert sum(sizes.values()) == sum(lengths)
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sizes.values())


SPACES = ["a b", "a  b", " a", "a ", "a   b", "a\n b", "a \n  b", "\n\n x", "x\t y", "it's  'll", "<|endoftext|> a", "", "it's. so, be.", "a.. b,. é, 漢. ́.", "x.\ny. z", "1. 2, I."]


@pytest.mark.parametrize("seed", range(3))
def test_pieces_encode_like_the_whole(seed):
    rng = random.Random(seed)
    made = ["".join(rng.choices("ab é.,'0 \n\t  ", k=60)) for _ in range(200)]
    for name, split in (("byte_bpe_50k.json", pieces.space_pieces), ("word_bpe_49k.json", pieces.word_pieces)):
        encoder = pieces.tokenizer(name)
        memory = pieces.Memory(encoder, list)
        for text in SPACES + made:
            own = split(text)
            known = memory.of(own)
            whole = encoder.encode(text, add_special_tokens=False).ids
            assert [x for p in own for x in known[p]] == whole, repr(text)


@pytest.mark.parametrize("seed", range(4))
def test_resynchronised_counts(seed):
    rng = random.Random(seed)
    encoder = pieces.tokenizer("word_bpe_49k.json")
    parts = ["word", "été", "it's", "x" * 90, "12.5%", "漢字", "<|endoftext|>", "́e", "-" * 40]
    text = "".join(rng.choice(parts) + rng.choice([" ", "\n", "", "  "]) for _ in range(400))
    whole = len(encoder.encode(text, add_special_tokens=False).ids)
    for chunk, overlap in ((200, 20), (97, 8), (1000, 64)):
        assert token_counts.count_huge(text, encoder, chunk, overlap) == whole


def test_overlap_without_boundary_is_widened():
    encoder = pieces.tokenizer("word_bpe_49k.json")
    text = "ab cd " + "e" * 700 + " fg " + "h" * 900
    whole = len(encoder.encode(text, add_special_tokens=False).ids)
    assert token_counts.count_huge(text, encoder, 64, 8) == whole


def test_drawn_counts_follow_the_law():
    rng = np.random.default_rng(1)
    drawn = np.array([sharding.draw_count(rng, 30, 50, 20) for _ in range(4000)])
    expected = np.random.default_rng(2).hypergeometric(30, 50, 20, 200_000)
    assert abs(drawn.mean() - expected.mean()) < 0.15
    assert abs(drawn.std() - expected.std()) < 0.1
    assert sharding.draw_count(rng, 10**12, 10**12, 10) <= 10  # no bound on the population
    counts = [17, 0, 5, 300, 1]
    matrix = sharding.draw_matrix(counts, 8, 3)
    assert [sum(row) for row in matrix] == counts
    sizes = np.sum(matrix, axis=0)
    assert sizes.max() - sizes.min() <= 1


def test_shards_ignore_order_and_groups():
    """A group of equal rows spreads over the shards as a random draw would."""
    shares = np.array([sharding.draw_matrix([100] * 8, 8, seed)[0] for seed in range(300)])
    assert np.allclose(shares.mean(axis=0), 12.5, atol=0.8)


def test_block_max_bounds_lose_nothing():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 25))] for _ in range(70)]
    df = Counter(w for t in texts for w in set(t))
    rows = [
        {"__uid": k, "item_id": k, "question": t if j == 0 else None, "answer": [] if j == 0 else None,
         "length": len(t), "word": w, "tf": n, "df": df[w]}
        for k, t in enumerate(texts)
        for j, (w, n) in enumerate(sorted(Counter(t).items()))
    ]
    index = decontamination.build(rows, len(texts), sum(map(len, texts)) / len(texts), 40)
    weights = {}
    for word, k in index.terms.items():
        term, places, impacts = index.posted
        own = term == k
        weights[word] = dict(zip(places[own].tolist(), impacts[own].tolist(), strict=True))
    query = [rng.choice(vocabulary) for _ in range(300)]
    query[100:110] = texts[3][:10]
    for threshold in (0.2, 0.35, 0.6):
        found = {(p, i) for p, i, _ in index.retrieve(query, threshold)}
        expected = set()
        for p in range(0, max(1, -(-(len(query) - 40) // 20) + 1)):
            terms = set(query[p * 20 : p * 20 + 40])
            for i in range(len(texts)):
                if sum(weights.get(w, {}).get(i, 0) for w in terms) >= threshold:
                    expected.add((p, i))
        assert found == expected
    assert expected or threshold


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(3)
    shared, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    a = near_dedup.signature(np.concatenate([shared, left]))
    b = near_dedup.signature(np.concatenate([shared, right]))
    assert abs((a == b).mean() - 0.75) < 0.1


def test_regions():
    rng = np.random.default_rng(4)
    sketch = rng.integers(0, 2**63, (40, 2)).astype(np.uint64)
    small = np.sort(rng.integers(0, 2**63, 8).astype(np.uint64))
    i, j = near_dedup.region_pairs(small, sketch[:8], 0)
    assert len(set(zip(i.tolist(), j.tolist(), strict=True))) == 28
    # A deep region costs a bounded number of pairs per node.
    equal = np.zeros(5000, np.uint64)
    many = np.repeat(sketch, 125, axis=0)
    i, _ = near_dedup.region_pairs(equal, many, 0)
    assert len(i) < 12 * 5000


def test_closed_groups():
    import pandas as pd

    sets = [np.arange(100), np.arange(0, 92), np.arange(500, 600), np.arange(10, 100), np.arange(0, 74)]
    frame = pd.DataFrame({"node": [7, 3, 9, 5, 1], "set": [x.astype(np.uint64).tobytes() for x in sets]})
    got = dict(near_dedup._closed(frame).itertuples(index=False))
    assert got == {7: 1, 3: 1, 9: 9, 5: 1, 1: 1}  # 1 is near 3 only


def test_crowd_bounds_lose_no_pair():
    rng = np.random.default_rng(7)
    core = rng.integers(0, 2**64, 120, np.uint64)
    sets = []
    for _ in range(120):
        own = rng.integers(0, 2**64, rng.integers(0, 30), np.uint64)
        sets.append(np.unique(np.concatenate([rng.choice(core, rng.integers(95, 121), replace=False), own])))
    counts = np.zeros(1 << near_dedup.COUNT_BITS, np.int64)
    for x in sets:
        counts[near_dedup._rarity_slot(x)] += 1
    postings = {}
    for k, x in enumerate(sets):
        for place, shingle in zip(*near_dedup.prefix(x, counts), strict=True):
            postings.setdefault(int(shingle), []).append((place, k, len(x), near_dedup.parity(x)))
    found = set()
    for own in postings.values():
        place, node, n = (np.array([e[k] for e in own]) for k in range(3))
        bits = np.stack([e[3] for e in own]).view(np.uint64)
        for across in (False, True):
            i, j = near_dedup.posting_pairs(place, node, n, bits, node % 2, across)
            assert not across or (node[i] % 2 != node[j] % 2).all()
            found |= set(zip(node[i].tolist(), node[j].tolist(), strict=True)) if not across else set()
    linked = {(i, j) for i in range(120) for j in range(i + 1, 120) if near_dedup._linked(sets[i], sets[j])}
    assert linked and linked <= found


def test_crowds_lose_no_link(make):
    """Texts that share a long passage, pairwise just under the threshold, but for some pairs."""
    from test_contracts import brute_components, shingle_set

    passage = " ".join(f"p{k}" for k in range(152))  # 148 shingles
    texts = []
    for k in range(600):
        own = [f"d{k}w{x}" for x in range(26)]
        if k >= 560:  # two more shingles of another text make 150 of 174: 0.757
            own[:2] = f"d{k - 40}w0", f"d{k - 40}w1"
        texts.append(f"{passage} {' '.join(own)}")
    roots = brute_components({k: shingle_set(x) for k, x in enumerate(texts)})
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(make(*texts)).collect()}
    assert got == roots
    assert sum(k != r for k, r in got.items()) == 40


def test_components_of_long_chains(spark):
    from broadsheet.llm.components import components

    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 103), (103, 101)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "chain").collect()
    assert {r["node"]: r["root"] for r in found} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 103: 100}


def test_tagger_gradients():
    rng = np.random.default_rng(0)
    ids, tags = rng.integers(0, 129, (7, 3)), rng.integers(0, 3, (7, 3))
    model = Tagger(3, embed=4, hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grads = model.gradients(ids, tags)
    for name, values in model.p.items():
        flat = values.reshape(-1)
        for k in rng.choice(len(flat), min(6, len(flat)), replace=False):
            kept = flat[k]
            flat[k] = kept + 1e-3
            up, _ = model.gradients(ids, tags)
            flat[k] = kept - 1e-3
            down, _ = model.gradients(ids, tags)
            flat[k] = kept
            assert grads[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_tagger_learns_and_adds_spans(make):
    rng = random.Random(2)
    texts = []
    for _ in range(150):
        digits = "".join(rng.choices("0123456789", k=10))
        phone = f"+1 ({digits[:3]}) {digits[3:6]}-{digits[6:]}"
        word = "".join(rng.choices("abcdefgh", k=rng.randint(4, 30)))
        texts.append(f"{word} some {phone} words {word} mail {word}@ab{digits[0]}.example.com and {digits[:2]} more {word}")
    tagger = pii.train(make(*texts), limit=120, passes=12)
    found = pii.find_spans(["please call 974-555-3436 today, she said, it is open until late"], tagger)[0]
    assert [(s["kind"], s["base"]) for s in found] == [("phone", False)]
    assert pii.find_spans(["there are 12 rows and 7 columns in it, with 3 more to come"], tagger)[0] == []


def test_spans_run_through_windows():
    n = pii.WINDOW * 3
    starts = list(range(0, n - pii.WINDOW + 1, pii.STEP))
    tags = np.zeros((len(starts), pii.WINDOW), np.int64)
    for row, at in enumerate(starts):
        for c in range(pii.WINDOW):
            tags[row, c] = 1 if 40 <= at + c < 200 else 0
    spans = pii.reconcile(n, starts, tags, np.ones(tags.shape))
    assert [s[:3] for s in spans] == [("email", 40, 200)]


def test_windows_cover_triggers():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choices("ab1@", weights=[50, 50, 1, 1], k=rng.randint(1, 500)))
        starts = set(pii.windows(text))
        last = max(0, -(-(len(text) - pii.WINDOW) // pii.STEP))
        assert starts == {
            k * pii.STEP
            for k in range(last + 1)
            if pii.TRIGGER.search(text[k * pii.STEP : k * pii.STEP + pii.WINDOW])
        }


def test_char_ids():
    assert char_ids("aé漢!😀").tolist() == [97, 128, 128, 33, 129]


def test_sketches_merge(spark):
    rng = random.Random(1)
    rows = [("en", f"s{k % 3}", 100, rng.randint(200, 1500), rng.randint(0, 90), 0, 0, 4, 3) for k in range(900)]
    names = "lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper bigint"
    sketch = quality.sketches(spark.createDataFrame(rows, names))
    got = quality.quantiles(sketch, ["lang"]).where("measure = 'word_length'").first()
    values = sorted(r[3] / r[2] for r in rows)
    for name, q in (("p10", 0.1), ("q2", 0.5), ("p90", 0.9)):
        assert got[name] == pytest.approx(values[int(q * 900) - 1], rel=0.02)
    assert got["total"] == 900


def test_fences_follow_the_group(make):
    """The same text stands out in a group of plain prose and not in one of tables."""
    rng = random.Random(3)

    def text(symbols):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(200)]
        return " ".join(words + ["|"] * symbols)

    rows = [(k, text(rng.randint(0, 2)), "en", "prose") for k in range(300)]
    rows += [(300 + k, text(rng.randint(0, 60)), "en", "tables") for k in range(300)]
    asked = text(40)  # a sixth of its words
    rows += [(600, asked, "en", "prose"), (601, asked, "en", "tables")]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(make(*rows)).collect()}
    assert (kept[600], kept[601]) == (False, True)
    assert all(kept[k] for k in range(600))


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    head = [(b"", 50)] + [(f"w{k}".encode(), 40) for k in range(20)]
    totals = {b: (40 * n, n) for b, n in Counter(lm_scoring.bucket(w) for w, _ in head[1:]).items()}
    lexicon = lm_scoring.Lexicon(head, totals, 850, 21)
    model = lm_scoring.Model.first(lexicon.unigram)
    trainer = lm_scoring.Trainer(model, lexicon.unigram, 0.1, 1)
    first = lm_scoring.BUCKETS + 1
    chain = first + np.arange(20_000) % 10  # each word is followed by one other
    for at in range(2, len(chain) - 500, 500):
        w = chain[at : at + 500]
        trainer.update(w, chain[at - 1 : at + 499], chain[at - 2 : at + 498])
    near, far, total = model.tables()
    h1, h2 = rng.integers(0, lm_scoring.SYMBOLS, (2, 5))
    log = near[h1] + far[h2] - total[h1, h2][:, None]
    assert np.exp(log.astype(np.float64)).sum(axis=1) == pytest.approx(np.ones(5), rel=1e-3)
    sure = np.exp(near[chain[1:-1], chain[2:]] + far[chain[:-2], chain[2:]] - total[chain[1:-1], chain[:-2]])
    assert sure.mean() > 0.5


def test_sums_by_symbol_are_plain_and_quick_for_broadcast_floats():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, lm_scoring.SYMBOLS, lm_scoring.BATCH)
    values = rng.normal(size=(len(ids), lm_scoring.WIDTH)).astype(np.float32)
    values = pickle.loads(pickle.dumps(values)) * np.float32(1)  # as a task gets it
    plain = np.zeros((lm_scoring.SYMBOLS, lm_scoring.WIDTH))
    for k, row in zip(ids, values, strict=True):
        plain[k] += row
    assert lm_scoring._scatter(ids, values) == pytest.approx(plain, rel=1e-5, abs=1e-5)
    begun = time.process_time()
    for _ in range(100):
        lm_scoring._scatter(ids, values)
    assert time.process_time() - begun < 0.3  # adding float by float takes 0.7 s


def test_an_update_moves_as_the_gradients_of_single_tokens_say():
    unigram = np.full(lm_scoring.SYMBOLS, 1 / lm_scoring.SYMBOLS, np.float32)
    model = lm_scoring.Model.first(unigram)
    before = lm_scoring.Model(model.flat.copy())
    trainer = lm_scoring.Trainer(model, unigram, 0.1, 1)
    w, h1, h2 = np.random.default_rng(2).integers(0, 40, (3, 64))
    drawn = np.random.default_rng(1).random(lm_scoring.NOISE)
    noise = np.minimum(np.searchsorted(trainer.steps, drawn), lm_scoring.SYMBOLS - 1)
    grad = {n: np.zeros(s) for n, s in lm_scoring.Model.SHAPES.items()}
    for one, near, far in zip(w, h1, h2, strict=True):
        guess = before.r[near] * before.c[0] + before.r[far] * before.c[1]
        for k, seen in [(one, True), *((k, False) for k in noise)]:
            odds = np.exp(guess @ before.q[k] + before.b[k] - trainer.log_noise[k])
            pull = (1 / (1 + odds) if seen else -odds / (1 + odds)) / 8
            grad["q"][k] += pull * guess
            grad["b"][k] += pull
            for j, h in enumerate((near, far)):
                grad["r"][h] += pull * before.q[k] * before.c[j]
                grad["c"][j] += 0.01 * pull * before.q[k] * before.r[h]
    trainer.update(w, h1, h2)
    for name, g in grad.items():
        moved = getattr(before, name) + 0.1 * g / np.sqrt(0.1 + g * g)
        assert getattr(model, name) == pytest.approx(moved, rel=1e-3, abs=1e-4)


def test_shares_of_classes_sum_to_one():
    counts = {f"x{k}".encode(): k % 7 + 1 for k in range(2000)}
    head = [(b"", 100), *sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    totals = {}
    for w, c in counts.items():
        t, n = totals.get(lm_scoring.bucket(w), (0, 0))
        totals[lm_scoring.bucket(w)] = t + c, n + 1
    lexicon = lm_scoring.Lexicon(head, totals, sum(counts.values()) + 100, len(counts) + 1)
    for b in totals:
        own = [k for k in range(len(head)) if lexicon.symbol[k] == b]
        assert sum(10 ** lexicon.inside[k] for k in own) + 1 / lexicon.share[b] == pytest.approx(1)


def test_most_frequent_words(spark):
    counts = {f"w{k}".encode(): c for k, c in enumerate([500, 90, 90, 40, 7, 7, 1, 1, 1, 1])}
    table = spark.createDataFrame(list(counts.items()), "word binary, c bigint")
    expected = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    assert lm_scoring.most_frequent(table, 10) == expected
    assert lm_scoring.most_frequent(table, 9) == expected[:6]  # equal counts stay together
    assert lm_scoring.most_frequent(table, 3) == expected[:3]
    assert lm_scoring.most_frequent(table.limit(0), 3) == []


def test_the_end_is_always_in_the_head(spark):
    """Few long texts: more words are as frequent as the end than the head holds."""
    rows = [(b"", 1), *[(f"w{k}".encode(), 1) for k in range(40)], (b"often", 3)]
    counts = spark.createDataFrame([(bytearray(w), 0, c) for w, c in rows], "word binary, bucket int, c bigint")
    assert lm_scoring.most_frequent(counts, 5) == [(b"often", 3), (b"", 1)]
    assert lm_scoring.most_frequent(counts, 0) == [(b"", 1)]
    assert len(lm_scoring.most_frequent(counts, 100)) == 42
    assert lm_scoring.most_frequent(counts.limit(0), 5) == []


def test_long_texts_keep_their_end(make, monkeypatch):
    monkeypatch.setattr(lm_scoring.most_frequent, "__defaults__", (2,))
    docs = make((1, "a b c d", "en", "s"), (3, "a b c d e", "en", "s"))
    rows = lm_scoring.score(docs, F.lit(False), passes=1).collect()
    tokens = {"a": 2, "b": 2, "c": 2, "d": 2, "e": 1, None: 2}
    for r in rows:
        own = ["a", "b", "c", "d", *(["e"] if r["doc_id"] == 3 else []), None]
        assert r["n_known"] == r["n_tokens"] == len(own)
        assert r["base_score"] == pytest.approx(sum(math.log10((tokens[x] + 1) / (11 + 6 + 1)) for x in own))


def test_pieces_that_end_in_a_point_after_any_letter():
    """Every letter before a point or comma, as the library splits it."""
    letters = [chr(c) for c in range(0x30000) if chr(c).isalpha() and not 0x3400 <= c <= 0x9FFF
               and not 0xAC00 <= c <= 0xD7A3 and c < 0x20000]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = pieces.tokenizer(name)
        asked = [f"{head}{c}{mark}" for c in letters for head, mark in (("", "."), ("x", ","))]
        found = pieces.Memory(encoder, list).of(asked)
        whole = encoder.encode_batch_fast(asked, add_special_tokens=False)
        assert all(found[p] == e.ids for p, e in zip(asked, whole, strict=True))


def test_spans_apart():
    rng = random.Random(4)
    for _ in range(300):
        cuts = sorted(rng.sample(range(60), 12))
        found = [(a, b, k) for k, (a, b) in enumerate(zip(cuts[::2], cuts[1::2], strict=True))]
        busy = [(a, a + rng.randint(1, 9)) for a in rng.sample(range(60), 4)]
        free = [s for s in found if not any(a < s[1] and s[0] < b for a, b in busy)]
        assert spans.apart(found, busy) == free


def test_long_texts_are_scanned_in_linear_time():
    rng = random.Random(9)
    token = lambda: "".join(rng.choices("abcDEF123xyzQRS789", k=30))
    mixed = " ".join(token() for _ in range(300_000))
    for text in ("eyJ" * 3_300_000, "eyJ" + "a" * 10_000_000, mixed, "-----BEGIN " * 900_000,
                 "a://b:" * 1_500_000, "token " * 1_600_000, "token" + " " * 10_000_000):
        began = time.process_time()
        base = secrets.base_spans(text)
        found = secrets.more_spans(text, base)
        assert time.process_time() - began < 10
    assert len(found) == 0 and len(secrets.more_spans(mixed, [])) > 200_000
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"
    assert [s[:3] for s in secrets.more_spans(f"a {jwt}, b", [])] == [("jwt", 2, 2 + len(jwt))]
    assert secrets.more_spans(f"a {jwt}, b", [("assign", 0, 5, "x")]) == []


def test_byte_ids_are_those_of_the_library():
    encoder = pieces.tokenizer("byte_bpe_50k.json")
    fast = pieces.ByteEncoder(encoder)
    assert fast.fast
    rng = random.Random(3)
    chars = [chr(c) for c in range(0x2FFFF) if not 0xD800 <= c <= 0xDFFF]
    texts = ["", "<|endoftext|>", "a<|endoftext|> <|endoftext", "a" * 100_000, " " * 50_000 + "x", "it's we'LL 'd", "\r\n \n"]
    texts += ["".join(rng.choices(chars, k=200)) for _ in range(300)]
    texts += ["".join(rng.choices("ab 1.'\n\té漢\u0301\xa0<|>", k=400)) for _ in range(300)]
    texts += [f"{c}a {c} 1{c}. {c}{c}\n" for c in chars[::37]]
    whole = encoder.encode_batch_fast(texts, add_special_tokens=False)
    assert all(fast.ids(x).tolist() == e.ids for x, e in zip(texts, whole, strict=True))
    # A vocabulary of another kind is left to its library.
    other = pieces.ByteEncoder(pieces.tokenizer("word_bpe_49k.json"))
    assert other.fast is None
    assert other.ids("Some words").tolist() == other.encoder.encode("Some words", add_special_tokens=False).ids


def test_tagged_spans_take_their_runs_in():
    text = "call 974-555-3436 or x" + "9" * 90 + " end"
    spans_ = [("phone", 6, 15, 0.95), ("phone", 16, 17, 0.7), ("card", 30, 40, 0.9), ("ip", 41, 42, 0.9), ("ip", 3, 3, 1.0)]
    assert pii._made_whole(text, spans_) == [(5, 17, "phone", 0.95), (21, 40, "card", 0.9)]


def test_no_number_of_rows_switches_the_rule(make):
    """Fences move little by little as a small group grows."""
    rng = random.Random(6)
    prose = [" ".join("".join(rng.choices("abcde", k=5)) for _ in range(60)) for _ in range(1_000)]
    odd = [" ".join("".join(rng.choices("abcde", k=15)) for _ in range(60)) for _ in range(60)]
    highs = []
    for n in (1, 20, 40, 60):
        rows = [(k, x, "en", "a") for k, x in enumerate(prose)] + [(2_000 + k, x, "en", "b") for k, x in enumerate(odd[:n])]
        docs = make(*rows).select("doc_id", "lang", "source", "text")
        sketch = quality.sketches(docs.mapInArrow(quality._measured, quality._SCHEMA))
        fence = quality.thresholds(sketch).where("source = 'b' and measure = 'word_length'").first()
        highs.append(fence["high"])
    steps = np.diff(highs)
    assert (steps > 0).all() and highs[0] < 7 and 12 < highs[-1] < 16
    assert steps[0] > steps[1] > steps[2]
