"""New words of the token files: what goes through the whole tokenizer and what its model takes at once."""

from __future__ import annotations

import numpy as np

from trailcheck.llm import token_files
from trailcheck.llm.bpe import vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")
TEXTS = ["alpha!! Beta$$$ gamma, élan??? ñandú... (x) don't 's a's! a_b _ A__ ÉLAN!!! İx Σας, ς σ' ŉa ſs ªº ß ẞ 中文! éa! 12ab", "", "<|endoftext|>!! a<|endoftext|>b '' ''"]


class _Seen:
    """A tokenizer that notes the texts it is asked to encode."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode(self, text, **options):
        self.texts.append(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, some, **options):
        self.texts += some
        return self.tokenizer.encode_batch_fast(some, **options)

    def encode_batch(self, some, **options):
        self.texts += some
        return self.tokenizer.encode_batch(some, **options)


def test_ids_are_those_of_the_library():
    encoder = token_files.WordwiseEncoder(PATH)
    texts = TEXTS + [f"{chr(c)}{x}" for c in range(0x21, 0x600) for x in ("a", "é!", "'s", "")]
    for text, found in zip(texts, encoder.encode_all(texts)):
        assert found == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_words_of_plain_letters_skip_the_whole_tokenizer():
    encoder = token_files.WordwiseEncoder(PATH)
    seen = encoder.tokenizer = _Seen(encoder.tokenizer)
    encoder.encode_all(["alpha!! Beta$$$ gamma, élan??? ñandú"])
    assert not any(c.isalpha() for text in seen.texts for c in text)
