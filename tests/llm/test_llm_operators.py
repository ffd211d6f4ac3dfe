"""The training-data operators on small tables: brute force, and the edges every one must bear."""

import base64
import collections
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from shelfcast.llm import decontaminate, html_text, language, neighbours, packing, quality, simhash, token_output, tokens, url_filter
from shelfcast.llm.url_filter import Rule

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, length long, seed int"


def read(name, folder=FOLDER):
    return pq.read_table(f"{folder}/{name}.parquet").to_pydict()


def run(spark, prefix, folder=FOLDER):
    name = next(k for k in contract.queries() if k.startswith(prefix))
    return contract.queries()[name](spark, folder).collect()


@pytest.fixture(scope="module")
def texts():
    d = read("documents")
    return {i: t or "" for i, t in zip(d["doc_id"], d["text"], strict=True)}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and long texts, repeated rows and ids, and columns with clashing names."""
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t ", "de"), (4, "12345 !!", "en"), (5, "the same words are here again", "en"),
        (5, "the same words are here again", "en"), (6, "the same words are here again", None), (None, "no id at all here", "en"),
        (7, "long words " * 30_000, "en"), (8, "der die das und nicht", "de"), (9, "x", None),
    ]
    return spark.createDataFrame([(i, t, g, "s", 1, 0.5, "f", 3, 4) for i, t, g in rows], DOCS)


def test_token_counts(spark, texts):
    library = tokens.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op1_")}
    wanted = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts.items()}
    assert found == {i: (b, n, n > 1024) for i, (b, n) in wanted.items()}


def test_token_counts_edges(spark, odd):
    found = collections.Counter((r.doc_id, r.n_bytes) for r in tokens.count_tokens(odd).collect())
    assert found[(1, 0)] == 1 and found[(2, 0)] == 1 and found[(5, 29)] == 2 and found[(None, 17)] == 1
    assert sum(found.values()) == 11
    assert tokens.count_tokens(odd.limit(0)).count() == 0


def check_packing(rows, ids_of, capacity, documents):
    sequences, whole = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids_of(r.doc_id)[r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(own.astype("<u4").tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id].append((r.piece, r.start, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    for doc in documents:
        pieces = sorted(whole[doc])
        assert [n for _, _, n in pieces[:-1]] == [capacity] * (len(pieces) - 1)
        assert sum(n for _, _, n in pieces) == len(ids_of(doc))
    return sequences


def test_packing(spark, texts):
    library = tokens.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0]) for i, t in texts.items()}
    sequences = check_packing(run(spark, "op8_"), ids.get, 2048, texts)
    assert len(sequences) <= 1.02 * -(-sum(map(len, ids.values())) // 2048) + 1


def test_packing_edges(spark, odd):
    rows = packing.pack_documents(odd, capacity=64).collect()
    assert sum(r.doc_id in (1, 2, 3) and r.length == 1 for r in rows) == 3
    assert sum(r.doc_id == 5 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    long = sorted((r.piece, r.length) for r in rows if r.doc_id == 7)
    assert [n for _, n in long[:-1]] == [64] * (len(long) - 1) and len(long) > 900
    assert packing.pack_documents(odd.limit(0)).count() == 0
    with_ids = packing.pack_documents(odd, capacity=64, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)


def test_packed_ids_round_trip(spark, texts, odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    parts = collections.defaultdict(dict)
    rows = token_output.write_packed_ids(docs, capacity=256, window_tokens=20_000).collect()
    for r in rows:
        assert len(r.input_ids) == 512 and r.position_resets == r.cu_seqlens[:-1] and r.cu_seqlens[-1] == r.n_tokens
        assert token_output.positions(r.cu_seqlens)[r.position_resets].tolist() == [0] * len(r.position_resets)
        for doc, piece, ids in zip(r.doc_ids, r.pieces, token_output.read_rows(r.input_ids, r.cu_seqlens), strict=True):
            parts[doc][piece] = ids
    for doc, text in texts.items():
        whole = np.concatenate([parts[doc][p] for p in sorted(parts[doc])])
        assert whole.tolist() == [*coder.encode_ordinary(text), token_output.END_OF_TEXT]
    assert len({r.sequence_id for r in rows}) == len(rows)
    found = token_output.write_packed_ids(odd, capacity=64).collect()
    assert sum(d == 5 for r in found for d in r.doc_ids) == 2 and sum(d is None for r in found for d in r.doc_ids) == 1
    assert token_output.write_packed_ids(odd.limit(0)).count() == 0


def components(prints, bits):
    """Smallest id reachable, from all pairs."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            low = min(label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= bits)
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_near_duplicates(spark, texts):
    prints = {i: simhash.fingerprint(t) for i, t in texts.items()}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op6_")}
    labels = components(prints, 2)
    assert found == {i: (f"{prints[i]:016x}", labels[i]) for i in texts}


def test_near_duplicates_edges(spark, odd):
    found = collections.Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect())
    assert found[(5, 5)] == 2 and found[(6, 5)] == 1
    assert found[(1, 1)] == found[(2, 1)] == found[(3, 1)] == 1  # fingerprint zero links like any other
    assert sum(found.values()) == 11
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_links_connect_all_that_are_near(spark, bits):
    rng = np.random.default_rng(bits)
    centres = rng.integers(0, 2**63, 6)
    values = {int(c) for c in centres}
    for c in list(values):
        for _ in range(6):
            flips = rng.choice(63, int(rng.integers(1, 6)), replace=False)
            c ^= sum(1 << int(f) for f in flips)
            values.add(c)
    frame = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    links = simhash.fingerprint_links(frame, bits).collect()
    assert all((r.a ^ r.b).bit_count() <= bits for r in links)
    joined = {v: v for v in values}
    for _ in values:
        for r in links:
            joined[r.a] = joined[r.b] = min(joined[r.a], joined[r.b])
    assert joined == components({v: v for v in values}, bits)


def test_decontamination(spark, texts):
    items = read("benchmark")

    def words(text):
        bare = (re.sub(r"^\W+|\W+$", "", w).lower() for w in text.split())
        return [w for w in bare if w]

    def overlap(item, text):
        need = min(13, len(item))
        for shift in range(-len(item) + need, len(text) - need + 1):
            low, high = max(0, -shift), min(len(item), len(text) - shift)
            same = [item[i] == text[i + shift] for i in range(low, high)]
            if any(sum(same[i : i + need]) >= 0.8 * need for i in range(len(same) - need + 1)):
                return True
        return False

    found = {(r.doc_id, r.item_id) for r in run(spark, "op2_")}
    cut = {i: words(t) for i, t in texts.items()}
    wanted = set()
    for item_id, text in zip(items["item_id"], items["text"], strict=True):
        own = words(text)
        rare = set(own)
        for doc, have in cut.items():
            if len(rare.intersection(have)) >= 0.5 * min(13, len(rare)) and overlap(own, have):
                wanted.add((doc, item_id))
    assert found == wanted and found


def test_decontamination_edges(spark):
    shape = "doc_id long, text string, tokens string, item_id int"
    words = [f"w{i}" for i in range(60)]
    leak = words[:]
    leak[7], leak[19], leak[33] = "a", "b", "c"
    docs = spark.createDataFrame(
        [(1, "pre " * 9 + " ".join(leak), "", 0), (1, "pre " * 9 + " ".join(leak), "", 0), (2, " ".join(words[:8] * 5), "", 0),
         (3, None, "", 0), (4, "", "", 0), (5, "say one two three four five, please", "", 0), (6, "one two three four six", "", 0)],
        shape,
    )
    items = spark.createDataFrame(
        [(10, " ".join(words)), (11, "One two, three four FIVE."), (12, None), (13, ""), (14, "say")], "item_id long, text string"
    )
    found = {(r.doc_id, r.item_id): (r.doc_from, r.n_overlap, r.n_same) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(1, 10): (9, 60, 57), (5, 11): (1, 5, 5)}
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == 7


def test_decontamination_of_short_items(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(2, 14)}
    allowed = {n: n // 5 if n > 5 else 0 for n in items}
    docs = []
    for n, own in items.items():
        for changed in range(allowed[n] + 2):
            other = own[:]
            other[:changed] = ["x"] * changed
            docs.append((100 * n + changed, "pre " + " ".join(other)))
    rows = [(n, " ".join(own)) for n, own in items.items()] + [(99, "今日は良い天気ですね。")]
    docs.append((9900, "明日は、たぶん今日は良い大気ですねと言う。"))
    found = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    ).collect()
    wanted = {(100 * n + c, n): (1, n, n - c) for n in items for c in range(allowed[n] + 1)}
    assert {(r.doc_id, r.item_id): (r.doc_from, r.n_overlap, r.n_same) for r in found} == wanted | {(9900, 99): (6, 10, 9)}


def test_html(spark):
    pages = read("pages")
    found = {r.page_id: (r.url, r.text, r.n_chars) for r in run(spark, "op3_")}
    for i, url, source in zip(pages["page_id"], pages["url"], pages["html"], strict=True):
        inside = re.search("<article>(.*?)</article>", source, re.S)[1]
        blocks = [re.sub("<[^>]*>", "", b) for b in re.split("</?(?:p|h1)>", inside)]
        import html

        wanted = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert found[i] == (url, wanted, len(wanted))


def test_html_edges(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (3, "u", "<p>a\n b</p>" + "<p>c</p>" * 20_000, "x"), (None, "u", "t", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html_text.extract(pages).collect()
    assert collections.Counter(r.page_id for r in found)[2] == 2
    assert {r.page_id: r.text for r in found}[3] == "a b" + "\nc" * 20_000
    assert html_text.extract(pages.limit(0)).count() == 0


def test_neighbours(spark):
    e = read("embeddings")
    ids, points = np.array(e["vec_id"]), neighbours.unit_rows(np.array(e["embedding"], float))
    found = collections.defaultdict(dict)
    for r in run(spark, "op5_"):
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = 0
    queries = np.flatnonzero(ids % 50 == 0)
    for q in queries:
        cosines = points @ points[q]
        true = [v for _, v in sorted((-c, v) for c, v in zip(cosines, ids, strict=True) if v != ids[q])[:5]]
        own = found[ids[q]]
        assert sorted(own) == [1, 2, 3, 4, 5]
        hits += len(set(true) & {v for v, _ in own.values()})
        for vec, score in own.values():
            assert score == pytest.approx(cosines[np.flatnonzero(ids == vec)[0]], abs=1e-12)
    assert hits >= 0.9 * 5 * len(queries)


def test_neighbours_edges(spark):
    bad = float("nan")
    rows = [(50, [1.0, 0.0]), (3, [2.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, None),
            (7, [bad, 1.0]), (8, [None, 1.0]), (9, []), (10, [float("inf"), 1.0]), (None, [1.0, 1.0]), (100, [0.0]), (1, [1.0, 0.0]), (11, [1.0])]
    frame = spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<double>, entry int, score double")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest_neighbours(frame).collect())
    assert found == [(50, 1, 1, 1.0), (50, 2, 2, 1.0), (50, 3, 3, 1.0), (50, 4, 11, 1.0), (50, 5, 4, 0.0)]
    alone = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest_neighbours(alone).count() == 0
    assert neighbours.nearest_neighbours(alone.limit(0)).count() == 0


def test_quality(spark):
    folder = "/root/testdata/sf0.01"  # the smallest tables have too few labels to learn from
    labels = dict(zip(read("labels", folder)["doc_id"], read("labels", folder)["quality"], strict=True))
    found = {r.doc_id: r for r in run(spark, "op7_", folder)}
    assert set(found) == set(read("documents", folder)["doc_id"])
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    right = [found[i].predicted == q for i, q in labels.items() if found[i].held_out]
    assert np.mean(right) >= 0.9


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0.1), (8, 0, 0.1), (1, 1, 0.1), (99, 0, 0.1), (None, 1, 0.1)], "doc_id long, quality int, score double")
    field = quality.fit(odd, labels)
    judged = quality.score(odd, field, "own_score").collect()
    assert len(judged) == 11 and all(0 <= r.own_score <= 1 for r in judged) and judged[0].score == 0.5
    assert quality.fit(odd, labels.limit(0)) is None
    assert {r.own for r in quality.score(odd, None, "own").collect()} == {0.5}
    assert quality.score(odd.limit(0), field, "own").count() == 0


def test_language(spark):
    d = read("documents")
    found = {r.doc_id: r for r in run(spark, "op10_")}
    assert set(found) == set(d["doc_id"])
    truth = dict(zip(d["doc_id"], d["lang"], strict=True))
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(found[i].held_out == (i in set(held)) and 0 <= found[i].score <= 1 for i in truth)
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) >= 0.9


def test_language_edges(spark, odd):
    net = language.fit(odd, steps=5)
    assert net.labels == ["de", "en"]
    found = [(r.doc_id, r.guess) for r in language.predict(odd, net, "guess", "sure").collect()]
    assert len(found) == 11 and {g for i, g in found if i in (1, 2, 3, 4)} == {"und"}
    assert all(g in net.labels for i, g in found if i in (5, 6, 7, 8, 9, None))
    assert language.fit(odd.where("lang = 'xx'")) is None
    assert {r.guess for r in language.predict(odd, None, "guess", "sure").collect()} == {"und"}
    assert language.predict(odd.limit(0), net, "guess", "sure").count() == 0


def test_url_edges(spark):
    rules = [Rule("block", "a.com", "/x"), Rule("allow", "b.a.com", "/x"), Rule("block", "com", ""), Rule("allow", "com", "/xyz/")]
    urls = [None, "", "a.com/x", "http://A.com/x?q#f", "http://b.a.com/x/y", "http://c.b.a.com/x", "http://com", "http://ba.com/xyz/",
            "x://net/x", "http://a.com?/x", "http://", "http://a.com/xyz/1", "http://a.com/x"]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("a.com", "/x", "a.com/x", "block") and found[4] == ("b.a.com", "/x/y", "b.a.com/x", "allow")
    assert found[5][2:] == ("b.a.com/x", "allow") and found[6] == ("com", "", "com", "block")
    assert found[7][2:] == ("com/xyz/", "allow") and found[8] == ("net", "/x", None, "allow")
    assert found[9] == ("a.com", "", "com", "block") and found[10] == ("", "", None, "allow")
    assert found[11][2:] == ("com/xyz/", "allow")  # the longest wins
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = spark.range(0, 3000, 37).selectExpr("concat('k', id) AS key")
    cascade = url_filter.Cascade(listed, universe)
    judged = cascade.with_filters(universe, "f").select("key", cascade.holds(url_filter.F.col("key"), "f").alias("held")).collect()
    assert {r.key for r in judged if r.held} == {r.key for r in listed.collect()} and len(cascade.levels) > 1


def test_no_python_in_the_url_filter(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    plan = url_filter.judge_urls(pages, [Rule("block", "net", "/es/")])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)


def test_pipeline_stages(spark, odd, tmp_path):
    labels = spark.createDataFrame([(5, 1), (8, 1), (9, 0)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "der die das und nicht")], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for empty in (False, True):
        docs = odd.limit(0) if empty else odd
        for name, stage in corpus_pipeline.STAGES:
            done = stage(spark, docs, str(tmp_path)).cache()
            if name != "packing":
                assert done.columns == odd.columns
                docs = done
            assert empty == (done.count() == 0)
    ids = [r.doc_id for r in corpus_pipeline.one_of_each(spark, odd, str(tmp_path)).collect()]
    assert ids.count(5) == 1 and 6 not in ids and ids.count(None) == 1 and 2 not in ids
    kept = [r.doc_id for r in corpus_pipeline.known_language(spark, odd, str(tmp_path)).collect()]
    assert not {1, 2, 3, 4} & set(kept) and {5, 7, 8} <= set(kept)
    assert 8 not in [r.doc_id for r in corpus_pipeline.without_leaks(spark, odd, str(tmp_path)).collect()]


def test_pipeline_keeps_one_row_of_each_component(spark, tmp_path):
    rows = [(3, "red fox runs over the hill"), (7, "red fox runs over the hill"), (7, "blue whale dives under cold ice"),
            (8, "green parrot sings in a tree"), (8, "old clock strikes at noon today"), (9, "green parrot sings in a tree")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    kept = corpus_pipeline.one_of_each(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows[i] for i in (0, 2, 3, 4))


def test_pipeline_against_its_parts(spark, texts):
    d = read("documents")
    rows = contract.queries()["pipeline"](spark, FOLDER).collect()
    packed_ids = {r.doc_id for r in rows}
    library = tokens.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: np.array([*library.encode(texts[i], add_special_tokens=False).ids, 0]) for i in packed_ids}
    check_packing(rows, ids.get, 2048, packed_ids)
    scores = {r.doc_id: r.predicted for r in run(spark, "op7_")}
    good = {i for i in d["doc_id"] if scores[i] and any(map(str.isalpha, texts[i]))}
    firsts = components({i: simhash.fingerprint(texts[i]) for i in good}, 2)
    leaks = {r.doc_id for r in run(spark, "op2_")}
    assert packed_ids == {i for i in good if firsts[i] == i} - leaks


def test_neighbours_extreme_components(spark):
    """Very large and very small finite components neither overflow nor underflow the cosine."""
    rows = [(50, [1e200, 1e200]), (1, [1.0, 1.0]), (2, [1e-200, 1e-200]), (3, [1.0, -1.0]), (100, [-1e-300, 1e-300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest_neighbours(frame).collect())
    assert [(q, k, v) for q, k, v, _ in found] == [(50, 1, 1), (50, 2, 2), (50, 3, 3), (50, 4, 100), (100, 1, 1), (100, 2, 2), (100, 3, 50), (100, 4, 3)]
    scores = {(q, v): s for q, _, v, s in found}
    assert scores[(50, 1)] == pytest.approx(1.0) and scores[(50, 2)] == pytest.approx(1.0)
    assert scores[(50, 3)] == pytest.approx(0.0, abs=1e-12) and scores[(50, 100)] == pytest.approx(0.0, abs=1e-12)
    assert scores[(100, 3)] == pytest.approx(-1.0) and scores[(100, 50)] == pytest.approx(0.0, abs=1e-12)
