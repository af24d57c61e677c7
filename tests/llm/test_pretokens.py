"""Words taken by pre-token."""

from __future__ import annotations

import random

import numpy as np

from gridtide.llm import packing


def test_texts_of_latin_letters_go_to_the_model_by_pretoken():
    ids = packing.WordIds("word_bpe_49k.json", None)
    pick = random.Random(1)
    latin = "abzABZ019 ,.!?;:#*$%&|<>'\n\t\x1c\x00ÀÉÖÞßàéöøÿÇñÑst-_/@"
    for chars in (latin, latin + "×÷µªº\x85\xa0ſİıJǰ̌̀中国Σςд’…"):
        for _ in range(1500):
            text = "".join(pick.choice(chars) for _ in range(pick.randint(0, 30)))
            wanted = ids.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids.ids(text.encode()), "<u4").tolist() == wanted, text
        # Only the second kind of text is taken word by word.
        assert bool(ids.words) == (chars != latin)
