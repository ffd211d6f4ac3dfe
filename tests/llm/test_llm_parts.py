"""The parts of the training-data operators that need no Spark."""

import html
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import decontaminate, html_text, language, neighbours, packing, quality, simhash, token_output, tokens

TEXTS = [
    "", " ", "\n", "a", "Hello world", "two  blanks", " leading", "trailing ", "a \n b", "x\n\n y", "tab\tand space",
    "Don't stop, it's John's.\nNext line.", "<|endoftext|> inside <|endoftext|>,", "ends<|endoftext|>\nA", "naïve Äpfel ß ñ",
    "日本語 テキスト 123 ４５", "combining é ́x", "\x1cseparators\x85here", "a.\nB c,\nD", "UPPER.Case, MIX", "a" * 5000,
    "12,345.67 and $$$ ### !!", "emoji 👍🏽 ok", "x." * 300, " line para", "...\n...", "q\n", "\nq", "a .b ,c",
]


@pytest.fixture(scope="module")
def byte_level():
    return tokens.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts_equal_the_library(byte_level):
    encode, spaced = tokens._worker_counts(public_tokenizers.path("byte_bpe_50k.json"), b"", b"", 50)
    for text in TEXTS:
        assert tokens.count_text(text, encode, spaced) == len(byte_level.encode(text, add_special_tokens=False)), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB.,'s \n\té<|endoftext|>1 ")), max_size=60))
def test_counts_equal_the_library_on_any_text(text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, spaced = tokens._worker_counts(path, b"the a", bytes([1, 1]), 30)
    library = tokens.load_tokenizer(path)
    assert tokens.count_text(text, encode, spaced) == len(library.encode(text, add_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aBz.,'s \n\té́<|endoftext|>1 ")), max_size=60))
def test_lower_ids_equal_the_library_on_any_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokens.load_tokenizer(path)
    own = np.frombuffer(packing.lower_word_ids(path)(text), "<u4")
    assert own.tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = tokens.load_tokenizer(path), packing.lower_word_ids(path)
    for text in TEXTS:
        assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_16_bit_ids_equal_the_library():
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = token_output.byte_level_ids(path)
    for text in TEXTS:
        assert np.frombuffer(own(text), "<u2").tolist() == coder.encode_ordinary(text), text


def one_by_one(lengths, capacity):
    """Best-fit decreasing without any structure."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80))
def test_runs_are_best_fit_decreasing(lengths):
    counts = {x: lengths.count(x) for x in set(lengths)}
    bins: dict[int, list[tuple[int, int]]] = {}
    for length, _, pieces, first, each, offset in packing.best_fit_runs(counts, 20):
        for i in range(pieces):
            bins.setdefault(first + i // each, []).append((offset + i % each * length, length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
    placed = sorted(x for own in bins.values() for _, x in own)
    assert placed == sorted(lengths)
    assert sorted(20 - sum(x for _, x in own) for own in bins.values()) == one_by_one(lengths, 20)
    direct = token_output.place_pieces(lengths, 20)
    assert sorted(20 - sum(lengths[i] for i in own) for own in direct) == one_by_one(lengths, 20)


def test_runs_do_not_follow_the_number_of_pieces():
    rng = random.Random(1)
    counts = {length: rng.randint(1, 50) for length in range(1, 2049)}
    few = packing.best_fit_runs(counts, 2048)
    many = packing.best_fit_runs({k: v * 1000 for k, v in counts.items()}, 2048)
    assert len(many) < 2 * len(few) + 2048


def test_fingerprint_by_hand():
    import xxhash

    words = "a b c d e a b c".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint("A  b\tc\nd e a B c ") == wanted
    assert simhash.fingerprint("É x") == xxhash.xxh64_intdigest("É x", 42)  # only A-Z are lower-cased
    assert simhash.fingerprint("") == simhash.fingerprint(" \n ") == 0


def test_agreement_tolerates_substitutions():
    item = np.arange(1, 31, dtype=np.uint64)
    copy = np.concatenate([np.full(5, 99, np.uint64), item, np.full(5, 98, np.uint64)])
    assert decontaminate.agreeing(item, copy, 5) == (30, 30, 0)
    changed = copy.copy()
    changed[[9, 17, 25]] = 77
    covered, same, _ = decontaminate.agreeing(item, changed, 5)
    assert covered == 30 and same == 27
    assert decontaminate.agreeing(item, copy, 6)[0] == 0
    short = np.concatenate([np.full(20, 5, np.uint64), item[:8], np.full(20, 6, np.uint64)])
    assert decontaminate.agreeing(item, short, 20)[0] == 0  # eight tokens in a row are no overlap


def test_some_mask_survives_scattered_substitutions():
    rng = np.random.default_rng(0)
    tokens_ = rng.integers(1, 2**63, 40).astype(np.uint64)
    for trial in range(50):
        other = tokens_.copy()
        other[rng.choice(40, 6, replace=False)] = trial + 1
        hits = [np.intersect1d(decontaminate.seed_hashes(tokens_, m), decontaminate.seed_hashes(other, m)) for m in decontaminate.MASKS]
        assert any(map(len, hits))


@pytest.mark.parametrize("n, substitutions", [(13, 2), (12, 2), (11, 2), (10, 2), (9, 1), (8, 1), (7, 1), (6, 1)])
def test_some_mask_survives_every_pattern_of_substitutions(n, substitutions):
    assert n - substitutions >= decontaminate.MIN_AGREEMENT * n > n - substitutions - 1
    item = np.arange(1, n + 1, dtype=np.uint64)
    for changed in itertools.combinations(range(n), substitutions):
        other = item.copy()
        other[list(changed)] = 99
        masks = decontaminate.item_masks(n)
        assert any((decontaminate.seed_hashes(item, m) == decontaminate.seed_hashes(other, m)).any() for m in masks), changed


def test_scripts_without_blanks_are_cut_by_character():
    hashes = decontaminate.token_hashes
    assert len(hashes("今日は、良い天気 ok です。")) == 10
    assert hashes("今日は良い").tolist() == hashes("今 日 は、良い。").tolist()
    assert len(hashes("ภาษาไทย กำ กิ่ง")) == 11
    assert len(hashes("naïve Äpfel «한국어 텍스트» 12")) == 5


PARA = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."
P = f"<p>{PARA}</p>"


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("just text\nhere", "just text here"),
        ("<nav>x</nav>", ""),
        (f"<header><h1>Site</h1></header><main><section><h2>One</h2>{P}{P}</section><section><h2>Two</h2>{P}</section></main>"
         f"<div class='sidebar'>{P * 4}</div><div id=comments>{P * 5}</div>", f"One\n{PARA}\n{PARA}\nTwo\n{PARA}"),
        (f"<body><div class=menu><a href=x>a</a></div><div><div>{P * 3}<ul><li>one item<li>two items</ul></div></div>"
         "<div><a href=1>More links here</a> <a href=2>Another link</a></div>", f"{PARA}\n{PARA}\n{PARA}\none item\ntwo items"),
        (f"<article><h1>T</h1><p>{PARA}<p>{PARA}<script>var a='</p>'</script><form>no</form>tail &amp; &am; &quot;</article>",
         f'T\n{PARA}\n{PARA}\ntail & &am; "'),
        (f"<article><p><b>{PARA}<br><p>{PARA}</article><footer>&copy; x", f"{PARA}\n{PARA}"),
        (f'<article>{P}<p>cut <a href="x', f"{PARA}\ncut"),
        (f"<div class='cookie-notice'>{P}</div><article>{P}<aside>{P}</aside><div class=ad>{PARA}</div></article>", PARA),
    ],
)
def test_main_text(source, text):
    assert html_text.main_text(source) == text


@pytest.mark.parametrize("opening", [
    "<div class='content has-sidebar'>", "<div class=no-comments>", "<div class=related-story>", "<div id=share-price>",
    "<div class='content sidebar'>", "<div class=widget>", "<form method=post>", "<form><div class='banner'>",
])
def test_named_containers_keep_the_article(opening):
    closing = "</div></form>" if opening.startswith("<form><div") else "</form>" if "form" in opening else "</div>"
    around = f"<nav>menu</nav>{opening}<h1>T</h1>{P * 3}<div class='ad-slot'>{PARA}</div><form>Mail<input></form>{closing}"
    assert html_text.main_text(around) == "\n".join(["T", *[PARA] * 3])


def test_minor_named_parts_go():
    for name in ("sidebar", "main-nav", "sidebar-left", "ad-slot-2", "site-header", "cookie-notice", "comments"):
        assert html_text.main_text(f"<div class='{name}'>{P}</div><div class=text>{P * 2}</div>") == f"{PARA}\n{PARA}", name
    for name in ("share-price", "related-story", "no-comments"):
        assert html_text.main_text(f"<div class=text>{P * 2}<div class='{name}'>{P}</div></div>") == "\n".join([PARA] * 3), name
    assert html_text.main_text(f"<article>{P * 2}</article><div id=comments>{P * 5}</div>") == f"{PARA}\n{PARA}"
    assert html_text.main_text(f"<form><article>{P * 2}</article><div id=comments>{P * 5}</div></form>") == f"{PARA}\n{PARA}"
    assert html_text.main_text(f"<div class=widget><article>{P * 2}</article></div><p>x") == f"{PARA}\n{PARA}"
    assert html_text.main_text(f"<div class=widget>{P}</div>" * 3) == "\n".join([PARA] * 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<a href='x'>", "</a>", "<li>", "word ", "<script>", "</script>", "<!--", "-->", "<", ">", "&amp;", "\""]), max_size=40))
def test_any_markup_is_read(parts):
    text = html_text.main_text("".join(parts))
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n"))
    assert len(html.unescape("".join(parts))) >= len(re.sub(r"\s", "", text))


def test_gradients_by_differences():
    net = language.new_network(["x", "y"], 3, seed=1)
    spans = np.array([[1, 2, 3, 256], [4, 4, 1, 2], [0, 256, 256, 256]])
    targets = np.array([0, 1, 1])
    for w in net.weights():
        w[...] = w.astype(np.float32)
    _, grads = language.gradients(net, spans, targets)
    rng = np.random.default_rng(0)
    for w, g in zip(net.weights(), grads, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape) if w is not net.inputs else (int(rng.integers(0, 2)), int(rng.integers(0, 5)), int(rng.integers(0, 9)))
            kept, step = w[at], 1e-2
            w[at] = kept + step
            above, _ = language.gradients(net, spans, targets)
            w[at] = kept - step
            below, _ = language.gradients(net, spans, targets)
            w[at] = kept
            assert g[at] == pytest.approx((above - below) / (2 * step), abs=2e-3)


def test_scorer_equals_the_network():
    net = language.new_network(["x", "y", "z"], 4, seed=2)
    spans = language.cut_spans(bytes(range(150)), 64)
    sums = language.Scorer(net, rows=2).span_sums(spans)
    assert sums.sum() == pytest.approx(150, rel=1e-4)
    h = net.width
    first = spans[0]
    states = np.zeros((2, 65, h))
    for d, order in enumerate((first, first[::-1])):
        for t, symbol in enumerate(order):
            own, past = net.inputs[d][symbol] + net.bias[d], states[d, t] @ net.recurrent[d]
            z, r = (1 / (1 + np.exp(-(own[i * h : (i + 1) * h] + past[i * h : (i + 1) * h]))) for i in range(2))
            c = np.tanh(own[2 * h :] + r * past[2 * h :])
            states[d, t + 1] = (1 - z) * states[d, t] + z * c
    logits = np.concatenate([states[0, 1:], states[1, :0:-1]], axis=1) @ net.output + net.output_bias
    probs = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert sums[0] == pytest.approx(probs.sum(axis=0), abs=1e-3)


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    links = rng.normal(size=(2, 2))
    sizes = [1, 4, 2, 3]
    scores, ends = rng.normal(size=sum(sizes)), np.cumsum(sizes)
    good, expected = quality.marginals(scores, ends, links)
    wanted, pairs = [], np.zeros((2, 2))
    for end, n in zip(ends, sizes, strict=True):
        own = scores[end - n : end]
        paths = np.array([[k >> i & 1 for i in range(n)] for k in range(2**n)])
        weight = np.exp([(own * p).sum() + sum(links[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths])
        weight /= weight.sum()
        wanted += list((weight[:, None] * paths).sum(axis=0))
        for w, p in zip(weight, paths, strict=True):
            for a, b in zip(p, p[1:], strict=False):
                pairs[a, b] += w
    assert good == pytest.approx(np.array(wanted)) and expected == pytest.approx(pairs)


def test_features_of_odd_texts():
    for text in ("", "\n\n", " ", "x", "a b", "!" * 50, "word " * 3000):
        rows, sizes = quality.line_features(text)
        assert rows.shape == (text.count("\n") + 1, len(quality.FEATURES)) and len(sizes) == len(rows)
        assert np.isfinite(rows).all()


def test_probing_finds_every_code_in_the_radius():
    rng = np.random.default_rng(3)
    points = neighbours.unit_rows(rng.normal(size=(400, 16)))
    coder = neighbours.learn_coder(points, bits=64)
    codes = coder.codes(points)
    found = neighbours.search_block(coder, codes, points, codes[:20], points[:20], nearest=400)
    # asking for everything widens the radius until all are found
    assert all(len(rows) == 400 for _, rows, _ in found)
    for q, rows, cosines in neighbours.search_block(coder, codes, points, codes[:20], points[:20], nearest=3):
        gaps = np.bitwise_count(codes ^ codes[q]).sum(axis=1)
        inside = np.flatnonzero(gaps <= coder.radius)
        best = sorted(points[inside] @ points[q], reverse=True)[:4]
        assert sorted(cosines, reverse=True)[:4] == pytest.approx(best)
