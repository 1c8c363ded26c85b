"""Ranked search, phrase collocations and the language model against plain versions."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from waybill.llm import collocations, interpolated_lm, ranked_search
from waybill.llm.common import utf8

LONG = "a rather long text " * 6_000 + "x" * 300_000


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    words = [f"w{k}" for k in range(12)] + ["Éa", "B2", "x.y", "a,b"]
    texts = [" ".join(pick.choices(words, range(16, 0, -1), k=pick.randint(1, 40))) for _ in range(60)]
    texts += [texts[0], texts[0], None, "", " \n\t ", ".,;", LONG, "w0 w1 w2 w3\nw4\x0bw5! w0\tw1 w2 w3"]
    found = [(k, t, ("en", "de", None)[k % 3]) for k, t in enumerate(texts)]
    return [*found, (0, texts[0], "en"), (None, "w1 w2 alone", "en"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    return df.withColumns({c: F.lit(k) for k, c in enumerate(("id", "item", "term", "step", "part", "phrase", "chunk", "fold", "rank", "score", "n"))})


# Ranked search


def ranks(rows, items, k):
    terms = lambda t: re.findall(ranked_search.TERM, (t or "").translate(brute._LOWER))
    own = [(i, Counter(terms(t))) for i, t, *_ in rows]
    own = [(i, c) for i, c in own if c]
    n_all, length = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in own:
            m = 50 + (50 * sum(c.values()) * n_all) // length
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0 and i is not None and item is not None:
                scored.append((-score, i))
        found += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(found)


@pytest.mark.parametrize("small", [False, True])
def test_ranks_equal_all_scores(spark, docs, rows, small, monkeypatch):
    if small:  # several steps, shards and blocks of items
        monkeypatch.setattr(ranked_search, "INDEX_BYTES", 300)
        monkeypatch.setattr(ranked_search, "SHARD_STEPS", 2)
        monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 2)
    items = [(1, "w0 w15 B2 x.y"), (2, None), (3, ""), (4, "w0 w0 W1 éa Éa rather"), (5, "unheard of"), (None, "w1"), (6, rows[0][1])]
    table = spark.createDataFrame(items, "item_id int, text string").withColumn("term", F.lit(1))
    found = ranked_search.rank_documents(docs, table, k=7)
    assert sorted(tuple(r) for r in found.collect()) == ranks(rows, items, 7)
    assert ranked_search.rank_documents(docs.limit(0), table).count() == 0 == ranked_search.rank_documents(docs, table.limit(0)).count()


def test_skipping_keeps_the_best(monkeypatch):
    """Short and long lists, many ties, bounds that let most documents be skipped."""
    monkeypatch.setattr(ranked_search, "WINDOW", 64)
    pick = np.random.default_rng(3)
    for _ in range(60):
        n, k = int(pick.integers(1, 2_000)), int(pick.integers(1, 20))
        order = pick.permutation(n)
        lists, total = [], np.zeros(n, np.int64)
        for size in pick.integers(1, n + 1, int(pick.integers(1, 9))) // pick.integers(1, 60, 1):
            places = np.sort(pick.permutation(n)[: max(1, size)])
            adds = pick.integers(1, pick.integers(2, 50), len(places))
            total[places] += adds
            lists.append(ranked_search.PostingList(places, adds))
        best = [p for p in np.lexsort((order, -total)) if total[p]][:k]
        places, scores = ranked_search.best_places(lists, n, order, k)
        assert sorted(zip(places.tolist(), scores.tolist())) == sorted((int(p), int(total[p])) for p in best)


# Collocations


def phrase_counts(rows):
    counts = Counter()
    for _, text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(brute._LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for size in range(1, 5):
                counts.update((lang or "und", " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    return counts


@pytest.mark.parametrize("entries, burst", [(10**6, 4096), (400, 8), (1, 1)])
def test_tries_count_every_phrase(rows, entries, burst, monkeypatch):
    monkeypatch.setattr(collocations, "COUNT_BYTES", 2_000)
    names = pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])
    batch = pa.RecordBatch.from_arrays(list(names), names=["lang", "text"])
    mergers, words = {}, Counter()
    for lang, part, n, run in collocations.count_texts([batch], 3, entries, burst):
        merger = mergers.setdefault((lang, part), collocations.Merger(50))
        merger.add(run)
        words[lang] += n
        _, ids, _ = collocations.unpacked_run(run)
        assert ids.tolist() == sorted(ids.tolist())
    found = Counter()
    for (lang, _), merger in mergers.items():
        text, sizes, f = merger.frequent(1)
        assert sizes == [t.count(" ") + 1 for t in text]
        assert not found.keys() & {(lang, t) for t in text}
        found.update({(lang, t): n for t, n in zip(text, f)})
    expected = phrase_counts(rows)
    assert found == expected
    assert words == {k: sum(n for (lang, p), n in expected.items() if lang == k and " " not in p) for k in ("en", "de", "und")}


def test_a_run_costs_what_it_holds():
    # Before, each run went through all words of its task: 9.3 CPU seconds with 4,000 prefix partitions, 2.9 with four.
    texts = pa.array([" ".join(f"w{k}" for k in range(a, a + 1000)) for a in range(0, 200_000, 1000)])
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], names=["lang", "text"])
    spent = {}
    for parts in (4, 4, 4000):
        start = time.process_time()
        assert sum(n for _, _, n, _ in collocations.count_texts([batch], parts)) == 200_000
        spent[parts] = time.process_time() - start
    assert spent[4000] < 2 * spent[4] + 0.5


def test_collocations_equal_the_plain_version(docs, rows):
    least, counts, best = 4, phrase_counts(rows), {}
    candidates = {key: a for key, a in counts.items() if " " in key[1] and a >= least}
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        around = [x for (other, longer), x in candidates.items() if other == lang and longer != phrase and f" {phrase} " in f" {longer} "]
        if not any(100 * x >= 80 * a for x in around):
            parts = [(counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]) for k in range(1, len(words))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(parts))
            best.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    n = {lang: sum(x for (own, p), x in counts.items() if own == lang and " " not in p) for lang in best}
    expected = [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in best.items() for r, (s, a, p, left, right) in enumerate(sorted(own)[:25])]
    found = collocations.collocations(docs, least, 25)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert collocations.collocations(docs.limit(0)).count() == 0


# Language model


def plain_model(rows):
    """Scores by definition, with counts in dictionaries and the weights fitted text by text."""
    crc = lambda i: zlib.crc32(str(i).encode())
    texts = [[*brute._WORD.findall((t or "").translate(brute._LOWER)), 0] for _, t, _ in rows]
    held = [i is not None and crc(i) % 5 == 1 for i, *_ in rows]
    apart = [i is not None and not h and crc(i) // 5 % interpolated_lm.FOLDS == 0 for (i, *_), h in zip(rows, held)]

    def counted(chosen):
        one, two, three, after, after_two = (Counter() for _ in range(5))
        for words in chosen:
            padded = [-1, -1, *words]
            for u, v, w in zip(padded, padded[1:], words):
                one[w] += 1
                two[v, w] += 1
                three[u, v, w] += 1
                after[v] += 1
                after_two[u, v] += 1
        return one, two, three, after, after_two

    train = [t for t, h in zip(texts, held) if not h]
    n_words = len(counted(train)[0])

    def estimates(words, model):
        one, two, three, after, after_two = model
        total, padded = max(1, sum(one.values())), [-1, -1, *words]
        for u, v, w in zip(padded, padded[1:], words):
            x, y = after_two[u, v], after[v]
            yield x.bit_length(), y.bit_length(), three[u, v, w] / x if x else 0, two[v, w] / y if y else 0, one[w] / total

    def probability(own, weights):
        b3, b2, m3, m2, m1 = own
        a3, a2 = weights[0].get(b3, 0.5 if b3 else 0), weights[1].get(b2, 0.5 if b2 else 0)
        parts = [a3 * m3, (1 - a3) * a2 * m2, (1 - a3) * (1 - a2) * weights[2] * m1]
        return sum(parts) + (1 - a3) * (1 - a2) * (1 - weights[2]) / (n_words + 1), parts

    rest = counted([t for t, h, x in zip(texts, held, apart) if not h and not x])
    seen = [e for t, x in zip(texts, apart) if x for e in estimates(t, rest)]
    weights, before = ({}, {}, 0.5), -math.inf
    for _ in range(interpolated_lm.ROUNDS):
        use, chance, likelihood = (Counter(), Counter(), Counter()), (Counter(), Counter(), Counter()), 0
        for own in seen:
            p, parts = probability(own, weights)
            r3, r2, r1 = (x / p for x in parts)
            likelihood += math.log(p)
            for level, key, r, c in ((0, own[0], r3, 1), (1, own[1], r2, 1 - r3), (2, 0, r1, 1 - r3 - r2)):
                use[level][key] += r
                chance[level][key] += c
        most = interpolated_lm.MOST_WEIGHT
        weights = tuple({k: min(use[level][k] / c, most) if k else 0 for k, c in chance[level].items() if c > 0 or k == 0} for level in (0, 1))
        weights = (*weights, min(use[2][0] / chance[2][0], most))
        if likelihood / len(seen) - before < interpolated_lm.GAIN:
            break
        before = likelihood / len(seen)
    model = counted(train)
    one, total = model[0], sum(model[0].values())
    found = []
    for (i, *_), words, h in zip(rows, texts, held):
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (n_words + 1))) for w in words)
        score = sum(math.log10(probability(e, weights)[0]) for e in estimates(words, model))
        found.append((-1 if i is None else i, h, len(words), sum(one[w] > 0 for w in words), total, round(base, 6), round(score, 6)))
    return sorted(found)


@pytest.mark.parametrize("chunk_bytes", [10**9, 40_000])
def test_scores_equal_the_plain_model(docs, rows, chunk_bytes):
    scored = interpolated_lm.score_texts(docs, chunk_bytes=chunk_bytes).fillna({"doc_id": -1})
    found = sorted((*r[:5], round(r[5], 6), round(r[6], 6)) for r in scored.collect())
    assert found == plain_model(rows)


def test_language_model_edge_tables(spark, docs):
    assert interpolated_lm.score_texts(docs.limit(0)).count() == 0
    # A single text that is only scored: nothing is known, the end token included.
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    one = spark.createDataFrame([(alone, None)], "doc_id bigint, text string")
    assert [tuple(r) for r in interpolated_lm.score_texts(one).collect()] == [(alone, True, 1, 0, 0, 0.0, 0.0)]


def test_model_beats_single_words_on_held_out_texts(spark):
    """Texts with an order of words that single words do not know."""
    pick = random.Random(1)
    words = [f"v{k}" for k in range(50)]
    texts = []
    for _ in range(300):
        at = pick.randrange(50)
        texts.append(" ".join(words[(at := (at + pick.choice((1, 1, 1, 7))) % 50)] for _ in range(30)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    mean = interpolated_lm.score_texts(df).where("held_out").agg(F.avg("score"), F.avg("base_score")).first()
    assert mean[0] > mean[1] / 2


def test_packed_numbers():
    for values in ([], [0], [5, 5, 2**63], list(range(0, 10**6, 999))):
        own = np.array(values, np.uint64)
        assert interpolated_lm.unpacked(interpolated_lm.packed(own)).tolist() == values
        assert interpolated_lm.unpacked(interpolated_lm.packed(own, True), True).tolist() == values
    assert utf8(pa.array([None, "é"]))[1].tolist() == [0, 0, 2]
