"""Word ids: letters and the marks after them are encoded once each, and equal the library's."""

import random

import numpy as np
import public_tokenizers

from shelfcast.llm import packing, tokens


def test_letters_before_marks_are_encoded_once():
    asked = []
    words = packing.WordIds(lambda w: asked.append(w) or f"[{w}]".encode())
    made = [words[w] for w in ("alpha***", "alpha!", "éclat###", "alpha", "éclat", "***", "x1***", "œuf.")]
    assert made[:3] == [b"[alpha][***]", b"[alpha][!]", "[éclat][###]".encode()]
    assert asked == ["alpha", "***", "!", "éclat", "###", "x1***", "œuf."]


def test_ids_of_letters_and_marks_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = tokens.load_tokenizer(path), packing.lower_word_ids(path)
    draw = random.Random(5)
    signs = "aBÀéßµªº.,'s*<|>1²ŒœİΣς́ \n\t-_#zqẞ"
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(1, 14)))
        assert np.frombuffer(own(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
