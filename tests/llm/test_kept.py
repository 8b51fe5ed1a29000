"""What a worker keeps between tasks."""

import public_tokenizers

from lakestrata.llm import common, toxicity
from lakestrata.llm.library_ids import library_encoder


def test_another_operator_lets_the_encoder_go():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        data = file.read()
    encoder = library_encoder(data)
    assert library_encoder(data) is encoder  # kept between the tasks of one operator
    list(toxicity._types(iter([])))
    assert library_encoder(data) is not encoder
    assert list(common._kept) == ["library_ids"]
