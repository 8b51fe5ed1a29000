"""Token counts of whole texts by a sentencepiece model, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.text import quoted
from lakestrata.llm.common import by_bytes

#: A text of more characters than this is cut at safe boundaries into parts of about this length.
LONG_TEXT = 1 << 16


def safe_cut_model(model: bytes) -> bool:
    """Whether no piece of the model goes on after a blank that follows another character.

    The model then never merges across such a place. It must also leave texts as
    they are but for the blank put before them, and know no strings of its own
    that may hold blanks.
    """
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    norm = proto.normalizer_spec
    plain = norm.name == "identity" and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    own = any(p.type == p.USER_DEFINED for p in proto.pieces)
    return plain and not own and not any(re.search("[^▁]▁", p.piece) for p in proto.pieces)


def cut_safely(text: str, size: int = LONG_TEXT) -> list[str]:
    """The text in parts of about `size` characters, without the blank at each cut.

    A cut replaces a blank that follows neither a blank nor the mark the model
    writes for one; the library puts a blank before each part again.
    """
    parts, start = [], 0
    while len(text) - start > size:
        at = start + size
        while (at := text.find(" ", at)) >= 0 and text[at - 1] in " ▁":
            at += 1
        if at < 0 or at + 1 >= len(text):
            break
        parts.append(text[start:at])
        start = at + 1
    parts.append(text[start:])
    return parts


def token_counts(
    df: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `df`: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Only lengths leave the Arrow function. Within an Arrow batch texts are
    encoded in runs of balanced bytes, the long ones first cut where the model
    cannot merge (if the model has no such places, they are encoded whole). Null
    and empty texts have no bytes and no tokens; ids may be null or repeat. Rows
    are independent: no shuffle, and a lost task is run again. An empty table
    gives no rows; other columns are not read.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    cut = safe_cut_model(model)
    held = df.sparkSession.sparkContext.broadcast(model)  # one vocabulary file
    source = df.select(
        F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=held.value)
        for batch in batches:
            parts: list[str] = []
            owner: list[int] = []
            n_bytes = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                n_bytes.append(len(text.encode()))
                own = cut_safely(text) if cut and len(text) > LONG_TEXT else [text]
                parts += own
                owner += [i] * len(own)
            n_tokens = [0] * batch.num_rows
            for start, end in by_bytes(parts):
                for i, ids in zip(owner[start:end], model.encode(parts[start:end], num_threads=1), strict=True):
                    n_tokens[i] += len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
