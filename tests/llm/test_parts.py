"""Pieces of the operators on their own, and the awkward inputs every operator must take."""

import base64
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from waybill.llm import catalog, decontaminate, fingerprints, html_extract, licenses, ngram_join, repeats, sentencepiece_codec, token_counts, toxicity, url_filters
from waybill.llm.common import utf8
from waybill.llm.components import components
from waybill.llm.trie import DoubleArrayTrie

MODEL = f"{catalog.TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{catalog.TOKENIZERS}/byte_bpe_50k.tiktoken"
LONG = " ".join(f"word{k} runs on" for k in range(20_000)) + "x" * 3_000
SOME = "Plain words of a short text, with a mark.\nAnd a second line of it, which is longer than the first by far."


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and names that operators use inside."""
    rows = [(1, SOME, "en", "s", 5), (1, SOME, "en", "s", 5), (2, SOME, None, None, None), (None, SOME + " More of it here.", "en", "s", 1)]
    rows += [(3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4), (6, LONG, "en", "s", 9), (None, None, None, None, None)]
    rows += [(7, "▁ odd \U0001f600 éß\u0000 bytes", "en", "s", 3), (8, "Released under the MIT License.", "en", "s", 31)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = {c: F.lit(k) for k, c in enumerate(("row", "rank", "key", "score", "n", "label", "own", "left", "starts", "id", "path"))}
    return df.withColumns(extra)


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.UnigramModel.load(MODEL)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 0, k % 2) for k in range(9)] + [(None, 0, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")


def test_every_operator_takes_awkward_rows(spark, awkward, labels, model):
    n = awkward.count()
    benchmark = decontaminate.Benchmark([(1, "And a second line of it, which is longer"), (2, None), (3, "")])
    vocabulary = token_counts.byte_vocabulary(RANKS)
    for docs, rows in ((awkward, n), (awkward.limit(0), 0)):
        joined = ngram_join.shingle_components(docs).collect()
        assert len(joined) == rows
        if rows:
            # The two ids of one text and the null id, whose text is much the same, are one component of id 1.
            assert {(r.doc_id, r.component_id) for r in joined if r.n_shingles > 1 and r.doc_id in (1, 2, None)} >= {(1, 1), (2, 1)}
            assert all(r.component_id == r.doc_id for r in joined if r.n_shingles == 0)
        kept = ngram_join.one_of_each(docs)
        assert kept.columns == docs.columns and kept.where("text IS NULL OR trim(text) = ''").count() == docs.where("text IS NULL OR trim(text) = ''").count()
        assert kept.where(F.col("text") == SOME).count() == min(rows, 1)
        index = toxicity.fit(docs, labels)
        scored = toxicity.with_score(docs, index)
        assert scored.count() == rows and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert toxicity.evidence(docs, index).count() == rows
        digests = repeats.repeat_digests(docs).collect()
        assert len(digests) == rows
        assert {r.n_removed for r in digests if r.doc_id == 1} <= {0}
        if rows:
            assert [r.n_removed for r in digests if r.doc_id == 2] == [len(SOME)]
        cut = repeats.without_repeats(docs, 50)
        assert cut.columns == docs.columns and cut.where("doc_id = 2").count() == 0
        hits = decontaminate.contaminations(docs, benchmark).collect()
        assert {r.doc_id for r in hits} == ({1, 2, None} if rows else set())
        assert decontaminate.without_contaminated(docs, benchmark).columns == docs.columns
        back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model), model)
        assert sorted(map(repr, sentencepiece_codec.with_pieces(docs, model).collect())) == sorted(map(repr, back.collect()))
        assert back.where("decoded <> replace(coalesce(text, ''), '▁', ' ')").count() == 0
        assert sentencepiece_codec.round_trips(docs, model).count() == rows
        assert token_counts.token_counts(docs, vocabulary).where("n_unknown > 0").count() == 0
        near = fingerprints.compare_versions(docs).collect()
        assert len(near) == rows and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in near)
        found = licenses.scan_licenses(docs.withColumn("path", F.concat(F.lit("a/b/"), F.col("doc_id")))).collect()
        assert len(found) == rows
        if rows:
            assert {r.origin for r in found if r.path} == {"file", "inherited"} and {r.origin for r in found if r.path is None} == {"none"}
        pages = docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://A.Net/x/"), "doc_id").alias("url"), F.col("text").alias("html"), "key")
        assert html_extract.extract_main_text(pages).count() == rows
        assert url_filters.judge_urls(pages).count() == rows


def test_pipeline_takes_awkward_rows(spark, awkward, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for docs in (awkward, awkward.limit(0)):
        found = docs
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, found, str(tmp_path))
        assert set(docs.columns) <= set(found.columns)
        rows = found.collect()
        assert len([r for r in rows if r.text == SOME]) == (docs is awkward)
        assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows)


def test_components_of_a_long_chain(spark):
    n = 3000
    chain = spark.range(1, n).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")).repartition(7)
    found = components(chain.unionByName(spark.createDataFrame([(n + 5, n + 9), (n + 9, n + 7)], "a long, b long"))).collect()
    assert {(r.node, r.label) for r in found} == {(k, 0) for k in range(n)} | {(n + k, n + 5) for k in (5, 7, 9)}
    assert components(chain.limit(0)).count() == 0


def test_tiles_split_a_group_and_lose_no_link(spark, monkeypatch):
    """Sixty texts that share most words: many keys with many classes, more than a tile holds."""
    monkeypatch.setattr(ngram_join, "TILE", 7)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = {}
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size, percent in ((4, 85), (5, 80)):
        found = {r.doc_id: r.component_id for r in ngram_join.shingle_components(docs, size, percent).collect()}
        assert found == brute.components(texts, size, percent)


def test_repeats_inside_and_across(spark):
    rng = random.Random(2)
    passage = ["".join(rng.choice("abc ") for _ in range(90)) for _ in range(4)]
    texts = {}
    for i in range(40):
        parts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 60))) for _ in range(3)]
        near = list(rng.choice(passage))
        near[rng.randrange(90)] = "z"
        texts[i] = parts[0] + rng.choice(passage) + parts[1] + "".join(near) + parts[2] + "ab" * rng.randint(0, 60)
    docs = spark.createDataFrame([*texts.items(), (40, None)], "doc_id long, text string")
    expected = {i: (len(texts.get(i, "")) - len(kept), runs) for i, (kept, runs) in brute.kept_bytes(texts | {40: None}, 50).items()}
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.repeat_digests(docs).collect()} == expected


def test_rows_without_a_partner_get_no_bitmaps():
    rng = np.random.default_rng(3)
    group = np.sort(rng.integers(0, 40, 900))
    n, pos = rng.integers(5, 60, 900), rng.integers(0, 12, 900)
    order = np.lexsort((n, group))
    n, pos, label, side = n[order], pos[order], rng.integers(0, 9, 900), np.where(group % 2, 2, rng.integers(0, 2, 900))
    expected = np.zeros(900, bool)
    for g in range(40):
        own = np.flatnonzero(group == g)
        # Full bitmaps turn no pair away.
        maps = [np.full(1, 2**64 - 1, np.uint64)] * len(own)
        for a, b in ngram_join.tile_pairs(n[own] + 64, pos[own], label[own], side[own], maps, 85):
            expected[own[a]] = expected[own[b]] = True
    found = ngram_join.comparable(group, n + 64, pos, label, side, 85)
    assert found.tolist() == expected.tolist()
    assert 0 < found.sum() < 900
    lots = [pa.RecordBatch.from_arrays([pa.array(group[a : a + 7]), pa.array(n[a : a + 7])], names=["key", "n"]) for a in range(0, 900, 7)]
    cut = list(ngram_join._whole_groups(iter(lots), ["key"]))
    assert pa.concat_tables(t for t, _ in cut)["n"].to_pylist() == n.tolist()
    keys = [set(t["key"].to_pylist()) for t, _ in cut]
    assert sum(map(len, keys)) == len(set(group.tolist()))


def test_suffix_arrays_hold_only_what_recurs():
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 256, 200, np.uint8).tobytes()
    strings = [rng.integers(0, 256, 270, np.uint8).tobytes() for _ in range(3000)]
    strings[7], strings[2000] = b"x" * 30 + passage + b"a" * 40, passage + b"b" * 70
    list(repeats.maximal_repeats(strings[:2], 150))
    tracemalloc.start()
    found = [(size, sorted(zip(rows.tolist(), offsets.tolist()))) for size, rows, offsets in repeats.maximal_repeats(strings, 150)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(200, [(7, 30), (2000, 0)])]
    # Before, the arrays of all strings took over 100 times their bytes.
    assert peak < 60 * 270 * 3000


def test_maximal_repeats_against_all_substrings():
    rng = random.Random(3)
    for _ in range(100):
        strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 20))): None for _ in range(5)})
        least = rng.randint(3, 5)
        found = {
            (strings[rows[0]][offsets[0] : offsets[0] + size], frozenset(zip(rows.tolist(), offsets.tolist(), strict=True)))
            for size, rows, offsets in repeats.maximal_repeats(strings, least)
        }
        places: dict[bytes, set] = {}
        for i, s in enumerate(strings):
            for a in range(len(s)):
                for b in range(a + least, len(s) + 1):
                    places.setdefault(s[a:b], set()).add((i, a))
        for part, own in places.items():
            lefts = {strings[i][a - 1] if a else ("start", i) for i, a in own}
            rights = {strings[i][a + len(part)] if a + len(part) < len(strings[i]) else ("end", i) for i, a in own}
            if len(own) > 1 and len(lefts) > 1 and len(rights) > 1:
                assert (part, frozenset(own)) in found
        assert all(own == places[part] for part, own in found)


def test_edited_items_are_found_and_others_are_not():
    rng = random.Random(1)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 300))).strip() for _ in range(20)]
    benchmark = decontaminate.Benchmark(list(enumerate(items)), segment=None)
    for n in range(60):
        k = rng.randrange(20)
        text, budget = bytearray(benchmark.texts[k]), int(benchmark.edits[k])
        for _ in range(budget + (n % 2) * (budget + 3)):
            at = rng.randrange(len(text))
            if rng.random() < 0.5:
                text[at] = ord("z")
            else:
                text.insert(at, ord("y"))
        document = "some words before " + text.decode() + " and after"
        data, bounds, _ = decontaminate.in_form(*utf8(pa.array([document])))
        hits = {item: edits for item, edits, *_ in benchmark.hits(data, bounds)[0]}
        true = brute.edits_within(benchmark.texts[k], bytes(data))
        assert hits == ({k: true} if true <= budget else {})


def _searched(items, *texts, **options):
    data, bounds, _ = decontaminate.in_form(*utf8(pa.array(texts)))
    return decontaminate.Benchmark(list(enumerate(items)), **options).hits(data, bounds)


def test_excerpts_of_items_are_found():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    items = [" ".join(word() for _ in range(40)) for _ in range(20)]
    cut = lambda item, a, b: "plain words before " + " ".join(item.split()[a:b]) + " and after it"
    for a, b in ((0, 30), (5, 35), (10, 40)):
        found = _searched(items, *(cut(item, a, b) for item in items))
        assert sum([k for k, *_ in own] == [n] for n, own in enumerate(found)) >= 18
        for item, own in zip(items, found, strict=True):
            assert all(x[1] == 0 and item[x[4] : x[5]] == cut(item, a, b)[x[2] : x[3]] for x in own)
    # The whole item goes before its segments; short excerpts and texts of other words are no hits.
    assert [own[0][4:] for own in _searched(items, *items)] == [(0, len(item)) for item in items]
    assert _searched(items, *(cut(item, 0, 8) for item in items), " ".join(word() for _ in range(3000))) == [[]] * 21


def test_best_end_equals_the_band():
    rng = random.Random(3)
    for _ in range(300):
        pattern = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 90)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30))) + pattern[rng.randint(0, 3) :] + b"ab" * rng.randint(0, 9)
        k = rng.randint(0, 6)
        best = decontaminate.banded(pattern, text, k)
        assert decontaminate.first_best_end(pattern, text, k) == (best and best[2])


def test_short_items_are_found_as_words():
    items = ["forty-two", "no", "no", "años", "a.b"]
    found = _searched(items, "Say NO, then.", "nobody has two notes", "Forty-two años; xa.b a.by", "", "a.b", "no")
    assert [[x[0] for x in own] for own in found] == [[1, 2], [], [0, 3], [], [4], [1, 2]]
    assert found[0][0][1:4] == (0, 4, 6)
    assert _searched(items, "no", shortest=3) == [[]]


def test_repetitive_texts_in_bounded_memory():
    items = ["x" * 1500, "ab" * 400, "ab" * 400 + "y" * 300, "quite another item of the benchmark, in words"]
    tracemalloc.start()
    found = _searched(items, "x" * 1_000_000, "ab" * 50_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[x[:3] for x in own] for own in found] == [[(0, 0, 0)], [(1, 0, 0), (2, 0, 0)]]
    assert found[1][1][4:] == (0, 120) and peak < 500_000_000


def test_regions_do_not_depend_on_the_lots(monkeypatch):
    rng = random.Random(11)
    items = ["".join(rng.choice("ab ") for _ in range(rng.randint(30, 400))) for _ in range(30)]
    texts = [item[rng.randint(0, 40) :] + items[rng.randrange(30)] + "".join(rng.choice("abc") for _ in range(50)) for item in items]
    whole = _searched(items, *texts)
    monkeypatch.setattr(decontaminate, "PAIRS", 50)
    assert _searched(items, *texts) == whole and sum(map(len, whole)) >= 30


def test_benchmark_in_blocks(spark):
    items = [(k, f"item number {k} has words of its own such as w{k * 7919} and v{k * 104729}") for k in range(40)]
    docs = [(k, "before it " + items[k][1] + " after it" if k < 40 else "nothing of the kind") for k in range(60)]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.search_benchmark(docs, items, block_bytes=600)
    assert {(r.doc_id, r.item_id) for r in found.where("whole AND edits = 0").collect()} == {(k, k) for k in range(40)}
    one = decontaminate.search_benchmark(docs, items)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, one.collect()))
    assert {r.doc_id for r in decontaminate.drop_benchmark(docs, items, block_bytes=600).collect()} == set(range(40, 60))


def test_longest_match_against_plain_search():
    rng = random.Random(4)
    first = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(8)}
    more = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(8)}
    matcher = token_counts.LongestMatch(first, more)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.choice([1, 3, 9, 300]))) for _ in range(4)) for _ in range(80)]
    found = token_counts.word_tokens(*utf8(pa.array(texts)), matcher, lead=b"")
    for text, row in zip(texts, found, strict=True):
        counts = [brute.greedy_pieces(w.encode(), first, more) for w in text.split()]
        assert list(row) == [len(counts), sum(1 if c is None else c for c in counts), counts.count(None)]


def test_long_texts_without_spaces_take_seconds(model):
    matcher = token_counts.LongestMatch(*token_counts.byte_vocabulary(RANKS))
    rng = random.Random(6)
    for text in ("".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(350_000)), "x" * 1_000_000):
        began = time.monotonic()
        numbers, bounds = model.encode(*sentencepiece_codec._led(pa.array([text])))
        assert sentencepiece_codec._decoded(model, numbers, bounds)[0].as_py() == text
        tokens = token_counts.word_tokens(*utf8(pa.array([text])), matcher)[0]
        assert tokens[0] == 1 and 0 < tokens[1] <= len(text.encode()) and tokens[2] == 0
        assert time.monotonic() - began < 20


def test_trie_holds_the_vocabulary():
    import numpy as np

    with open(RANKS, "rb") as lines:
        entries = {base64.b64decode(line.split()[0]): int(line.split()[1]) for line in lines}
    trie = DoubleArrayTrie.build(entries)
    for entry in list(entries)[::501]:
        node = np.array([0])
        for byte in entry:
            node = trie.step(node, np.array([byte]))
        assert trie.value[node[0]] == entries[entry]


def test_pieces_equal_the_public_library(model):
    """A unigram model of the same pieces and scores, run by the public library."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = pb.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for rank, piece in enumerate(p for p in proto.pieces if p.type == 1):
        piece.score = sentencepiece_codec.rank_score(rank)
    public = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["a short text", "  two  spaces ", "new\nline\ttab", "café 日本語 \U0001f600", "x" * 700, "", "unñ $$$ %%% ###"]
    # Long texts without spaces: cut where no piece spans, or searched byte by byte.
    rng = random.Random(5)
    texts += ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(4_000)), "日本語のテキスト、これは長い。" * 300, base64.b64encode(rng.randbytes(9_000)).decode()]
    texts += ["éß\U0001f600" * 400 + "word" * 500, "=" * 5_000 + " and " + "ab" * 4_000]
    numbers, bounds = model.encode(*sentencepiece_codec._led(pa.array(texts)))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert model.ids[numbers[a:b]].tolist() == public.encode(text)


def test_nearest_examples_are_exact():
    import numpy as np

    rng = random.Random(6)
    vectors = {}
    for _ in range(400):
        counts = tuple(sorted({rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(0, 4))}.items()))
        vectors.setdefault((counts, rng.randint(1, 300) if counts else 1), [0, 0])[rng.random() < 0.3] += 1
    index = toxicity.ExampleIndex.fit({f"t{k}": k for k in range(12)}, np.linspace(1, 4, 12), vectors, 0.3)
    for _ in range(50):
        counts = {rng.randrange(12): rng.randint(1, 3) for _ in range(3)}
        query = toxicity.unit_vector(counts, 90, index.idf)
        dense = sum(w * index.weights[t] for t, w in query.items())
        entries, cosines = index.nearest(query)
        assert cosines == pytest.approx(np.sort(dense)[::-1][: len(entries)])
        assert (index.toxic + index.clean)[entries].sum() >= toxicity.NEIGHBOURS


def test_page_furniture_is_left_out():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav>Menu</nav>
      <div class="content"><h1>Head</h1><p>First part, with marks &amp; more.<br>Still it.<p>Second <b>part</b>, too.</p>
      <div class="ad-box">Buy</div><script>var a = "</p>";</script><ul><li>One<li>Two</ul></div>
      <aside>Side</aside><form><p>Mail</p></form><div id="comments"><p>A comment, long and wordy, by a reader.</p></div><footer>End</footer></body></html>"""
    assert html_extract.main_text(page) == "Head\nFirst part, with marks & more. Still it.\nSecond part, too.\nOne\nTwo"
    assert html_extract.main_text("") == html_extract.main_text(None) == html_extract.main_text("<nav>Menu</nav>") == ""


def test_rules_and_templates(spark):
    urls = ["http://a.NET/x?q", "https://b.example.net/en/1#t", "http://example.com/de/5", "http://x.example.com/de", "ftp://y.org/fr/2", None, "no url", "http://net", "//h/p", "http://casino-x.example.com/en/4"]
    rows = url_filters.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("a.net", "/x", "net/", "block"),
        ("b.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.com", "/de/5", "example.com/de/", "block"),
        ("x.example.com", "/de", None, "allow"),
        ("y.org", "/fr/2", "org/fr/", "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("net", "", None, "allow"),
        ("", "", None, "allow"),
        ("casino-x.example.com", "/en/4", None, "allow"),
    ]
    many = spark.range(40).select("id", F.concat(F.lit("http://casino-x.example.com/en/"), "id").alias("url"))
    assert {r.verdict for r in url_filters.judge_urls(many, id_column="id").collect()} == {"block"}


def test_licence_notices_over_lines(spark):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:\n# 1. Redistributions of source code"
    gpl = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version."""
    mit = "MIT License\n\nCopyright (c) the authors\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"
    inside = "words before it say that all of this was " + "Licensed under the Apache License, Version 2.0, and so on without any break " + "word " * 40
    two = "Released under the MIT License. Licensed under CC BY 4.0."
    texts = {"a/x.py": bsd + "\ncode" * 300, "b/x.c": gpl.format(3), "c/x.c": gpl.format(2), "d/LICENSE": mit + " other" * 400, "d/e/y.c": "int main;", "f/z": inside, "g/z": two, "h/z": "free software and a license\nto use the work"}
    rows = [(k, path, text) for k, (path, text) in enumerate(texts.items())]
    found = {r.path: r for r in licenses.scan_licenses(spark.createDataFrame(rows + rows[:1], "doc_id long, path string, text string")).collect()}
    own = {path: r.licenses for path, r in found.items()}
    assert own == {"a/x.py": ["BSD-3-Clause"], "b/x.c": ["GPL-3.0"], "c/x.c": ["GPL-2.0"], "d/LICENSE": ["MIT"], "d/e/y.c": [], "f/z": ["Apache-2.0"], "g/z": ["CC-BY-4.0", "MIT"], "h/z": []}
    assert (found["a/x.py"].origin, found["d/LICENSE"].origin, found["d/e/y.c"].origin, found["d/e/y.c"].license) == ("header", "file", "inherited", "MIT")


def test_near_licences_are_told_apart(spark):
    head = "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU {}General Public License as published by\n * the Free Software Foundation, {}."
    texts = {
        "agpl": (head.format("Affero ", "either version 3 of the License, or (at your option) any later version"), ["AGPL-3.0"]),
        "gpl": (head.format("", "either version 3 of the License, or (at your option) any later version"), ["GPL-3.0"]),
        "named": ("Some Tool is free software: " + head.format("", "either version 3 of the License, or (at your option) any later version")[31:], ["GPL-3.0"]),
        "only": (head.format("", "version 2 of the License only"), ["GPL-2.0"]),
        "four": (head.format("", "either version 4 of the License, or (at your option) any later version"), []),
        "title": ("GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007", ["AGPL-3.0"]),
        "denied": ("This work is not licensed under the MIT License.", []),
        "denied inside": ("This work is not licensed under the GNU General Public License, version 3.", []),
        "granted": ("This work is, as was said, licensed under the MIT License.", ["MIT"]),
        "isc": ("Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted, provided that the above\n# copyright notice and this permission notice appear in all copies.", ["ISC"]),
        "unlicense": ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
        "zlib": ("// SPDX-License-Identifier: Zlib\nint x;", []),
    }
    texts |= {f"spdx {name}": (f"// SPDX-License-Identifier: {name}\nint main;", [name]) for name in licenses.SPDX_NAMES}
    texts |= {"spdx later": ("# SPDX-License-Identifier: GPL-3.0-or-later\nimport os", ["GPL-3.0"])}
    rows = [(k, f"{name}/x.c", text) for k, (name, (text, _)) in enumerate(texts.items())]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    assert {r.path[:-4]: r.licenses for r in found} == {name: own for name, (_, own) in texts.items()}


def test_page_text_is_whole():
    long, short = "A sentence of the story, as long as such are. " * 18, "A shorter part, which belongs to it as well."
    long = long.strip()
    page = "<body><nav>Menu</nav>{}<footer>End</footer></body>"
    # A title and a note beside the inner main element.
    inner = f'<article><h1>Title</h1><div class="post-content"><p>{long}</p></div><p>{short}</p></article>'
    assert html_extract.main_text(page.format(inner)) == f"Title\n{long}\n{short}"
    # Without marks: paragraphs of unlike length, a heading, and blocks of low score.
    assert html_extract.main_text(page.format(f"<div><p>{long}</p><p>{short}</p></div>")) == f"{long}\n{short}"
    assert html_extract.main_text(page.format(f"<div><h2>Head</h2><p>{long}</p><ul><li>One</li></ul><p>{short}</p></div>")) == f"Head\n{long}\nOne\n{short}"
    assert html_extract.main_text(page.format(f"<div><h2>Head</h2><p>{long}</p></div>")) == f"Head\n{long}"
    # Two posts.
    two = f'<div class="post"><p>{long}</p></div><div class="post"><p>{long} Again.</p></div>'
    assert html_extract.main_text(page.format(two)) == f"{long}\n{long} Again."


def test_names_alone_do_not_lose_an_article():
    long, short = " ".join(["A sentence of the story, as long as such are."] * 12), "A shorter part, which belongs to it."
    story = f"<p>{long}</p><p>{short}</p>"
    want, nav, end = f"{long}\n{short}", "<nav><a href='/'>Menu</a></nav>", "<footer>End</footer>"
    for body in (
        f'<div class="layout no-sidebar"><div class="content">{story}</div></div>',
        f'<div class="site has-sidebar"><article>{story}</article></div>',
        f'<div class="sidebar-layout"><article>{story}</article></div>',
        f'<form action="/x"><input name="q"><div>{story}</div></form>',
        f'<article><div class="share-post">{story}</div></article>',
        f'<article><p>{long}</p><section class="legal-analysis"><p>{short}</p></section></article>',
        f'<article class="post comments-open">{story}</article>',
        f'<article>{story}</article><div id="comments"><article class="comment"><p>{long} I agree.</p></article></div>',
        f'<article>{story}</article><article class="teaser"><p>{short}</p></article>',
        f'<article>{story}</article><div class="related"><article><a href="/y">{short}</a></article></div>',
        f'<article>{story}<div style="display: none"><p>{short}</p></div><p hidden>{short}</p></article>',
        f'<article>{story}<div class="social-links">Follow</div><p class="ad">Buy</p></article>',
    ):
        assert html_extract.main_text(f"<body>{nav}{body}{end}</body>") == want, body
    assert html_extract.main_text(f'<body>{nav}<article><p><a href="/z">{short}</a></p></article>{end}</body>') == short


@pytest.mark.parametrize("part", ["<a ", "<div>x", '<a href="', "<!x", "</b", "<title>t", "<b>x", "<li>x<ul>", "<p>x<p", "<a x='>y"])
def test_broken_pages_take_linear_time(part):
    began = time.monotonic()
    html_extract.main_text(part * (1_000_000 // len(part)))
    assert time.monotonic() - began < 12
