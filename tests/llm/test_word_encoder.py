"""Words of letters go to the model many at a time."""

import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakestrata.llm import library_ids

WORDS = ["The", "naïve", "ÉCOLE", "straße", "ñandú", "a", "unbelievably", "xqzkwv", "µ", "end", "ªº"]


@pytest.mark.parametrize(("name", "lead"), [("word_bpe_49k.json", ""), ("byte_bpe_50k.json", " "), ("byte_bpe_50k.json", "")])
def test_words_as_one_string_have_the_ids_of_each(name, lead):
    with open(public_tokenizers.path(name), "rb") as file:
        data = file.read()
    library = Tokenizer.from_str(data.decode())
    words = [lead + w for w in WORDS * 250]
    found = library_ids._word_encoder(library, json.loads(data))(words)
    wanted = {w: b"".join(i.to_bytes(4, "little") for i in library.encode(w, add_special_tokens=False).ids) for w in set(words)}
    assert found == [wanted[w] for w in words]


def test_a_file_that_may_split_letters_is_left_to_the_library():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        data = json.load(file)
    library = Tokenizer.from_str(json.dumps(data))
    for change in ({"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}):
        assert library_ids._word_encoder(library, data | change) is None
    named = [{"id": 1, "content": " hello", "special": True}]
    assert library_ids._word_encoder(library, data | {"added_tokens": named}) is None


def test_texts_of_all_kinds_have_the_librarys_ids():
    texts = ["", " ", "a  b", " The naïve ÉCOLE.", "one\ntwo,\n\nthree!! ", "x y", "tab\there", "日本 語", "a b c"]
    texts += [" ".join(WORDS) + "?!", "<|endoftext|> <|ENDOFTEXT|>", "don't WE'LL 42nd", "école öl", "İstanbul"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        with open(public_tokenizers.path(name), "rb") as file:
            data = file.read()
        library = Tokenizer.from_str(data.decode())
        wanted = [b"".join(i.to_bytes(4, "little") for i in library.encode(t, add_special_tokens=False).ids) for t in texts]
        assert library_ids.library_encoder(data)(texts) == wanted
