"""Ids of whole texts by the tokenizers library, within an Arrow function."""

from __future__ import annotations

import hashlib
import json
import os
import re
from codecs import charmap_decode
from collections.abc import Callable
from struct import pack

import numpy as np

from lakestrata.llm.common import WordIds, kept_by

#: Words that are encoded as one string.
_RUN = 1000
#: Splitting patterns that take a run of letters whole, besides that of a byte-level file.
_WHOLE_WORDS = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
#: Letters that every version of Unicode and of its tables treats alike, perhaps after a blank.
_WORD = re.compile("[ ]?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The character that a byte-level vocabulary writes for each byte; line feeds become blanks between words.
_OTHERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)} | {0x0A: 0x20}
_BYTES = "".join(chr(_OTHERS.get(b, b)) for b in range(256))


def _word_encoder(library, file: dict) -> Callable[[list[str]], list[bytes] | None] | None:
    """Packs the ids of what `_WORD` matches, by the library's model alone.

    Such words need no splitting pattern, so that many are one string, which is
    split at blanks; how many bytes each token stands for tells where a word ends.
    None if the file may treat letters in another way; the encoder gives None if
    tokens and words do not end together.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    model, splitter, normal = file["model"], file.get("pre_tokenizer") or {}, file.get("normalizer")
    suffix = model.get("end_of_word_suffix") or ""
    steps = splitter.get("pretokenizers", [splitter])
    bytes_only = steps[-1].get("type") == "ByteLevel" and not steps[-1].get("add_prefix_space")
    if len(steps) == 1:
        whole = bytes_only and steps[0].get("use_regex", True)
    else:
        split = steps[0]
        whole = (
            bytes_only
            and len(steps) == 2
            and not steps[1].get("use_regex", True)
            and split.get("type") == "Split"
            and split["pattern"].get("Regex") in _WHOLE_WORDS
            and (split["behavior"], split["invert"]) == ("Removed", True)
        )
    normals = (normal or {}).get("normalizers", [normal] if normal else [])
    lower = any(n["type"] == "Lowercase" for n in normals)
    blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    known = all(n["type"] in ("NFC", "Lowercase") or n == blanks for n in normals)
    letters = any(t["content"].strip().isalpha() for t in file.get("added_tokens") or [])
    if (
        not (whole and known)
        or letters
        or model.get("type") != "BPE"
        or model.get("dropout")
        or model.get("continuing_subword_prefix")
    ):
        return None
    words = Tokenizer(library.model)
    words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    sizes = np.zeros(max(model["vocab"].values()) + 1, np.int64)
    for token, i in model["vocab"].items():
        sizes[i] = len(token.removesuffix(suffix))

    def encode(strings: list[str]) -> list[bytes] | None:
        texts = ["\n".join(strings[i : i + _RUN]) + "\n" for i in range(0, len(strings), _RUN)]
        runs = [(text.lower() if lower else text).encode() for text in texts]
        written = [charmap_decode(run, "strict", _BYTES)[0] for run in runs]
        out = []
        for run, found in zip(runs, words.encode_batch_fast(written, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            reached = np.cumsum(sizes[ids])
            stops = np.flatnonzero(np.frombuffer(run, np.uint8) == 10)
            ends = stops - np.arange(len(stops))
            last = np.searchsorted(reached, ends)
            if not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
                return None
            data, cuts = ids.tobytes(), (4 * (last + 1)).tolist()
            out += [data[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    return encode


def library_encoder(data: bytes) -> WordIds:
    """Packs the ids that the library gives whole texts, without added special tokens.

    Kept between the tasks of a worker. Strings of special tokens inside a text
    are treated as the file says (the library's default). Texts may be cut at
    blanks and line feeds because neither kind of file lets a token go across:
    a byte-level file starts tokens at white space, a file with word ends drops it.
    """
    key = hashlib.sha256(data).digest()
    encoders: dict[bytes, WordIds] = kept_by("library_ids")
    if key not in encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(data.decode())
        file = json.loads(data)
        drops_space = bool(file["model"].get("end_of_word_suffix"))
        of_words = _word_encoder(library, file)

        def any_strings(strings: list[str]) -> list[bytes]:
            found = library.encode_batch_fast(strings, add_special_tokens=False)
            return [pack(f"<{len(ids)}I", *ids) for ids in (x.ids for x in found)]

        def encode(strings: list[str]) -> list[bytes]:
            if of_words is None:
                return any_strings(strings)
            plain = list(map(_WORD, strings))
            words = of_words([s for s, is_word in zip(strings, plain, strict=True) if is_word])
            if words is None:
                return any_strings(strings)
            others = any_strings([s for s, is_word in zip(strings, plain, strict=True) if not is_word])
            words, others = iter(words), iter(others)
            return [next(words) if is_word else next(others) for is_word in plain]

        encoders.clear()
        encoders[key] = WordIds(encode, drops_space)
    return encoders[key]
