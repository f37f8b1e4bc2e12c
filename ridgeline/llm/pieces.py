"""SentencePiece ids through a table of distinct chunks.

Where no piece of a model has a whitespace marker after another character, no
merge crosses from a character to a marker: a text falls into chunks, each a run
of markers with the word after it, and the ids of the text are those of its
chunks in order. Each task segments a distinct chunk once, with the library, and
puts the ids back by position. A model without that property, or one whose
normaliser rewrites texts, is applied to whole texts instead.

The table belongs to a task and is emptied when it has ``TABLE_CHUNKS`` entries;
longer chunks than ``TABLE_BYTES`` are segmented each time. Neither changes a result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.texts import Texts, map_texts

TABLE_CHUNKS = 150_000
TABLE_BYTES = 200
# Chunks are segmented by the library in lists of this many.
_LIST = 20_000
_MARK = "▁"


@lru_cache(maxsize=2)
def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def splits_at_markers(model: str) -> bool:
    """Whether chunks can be segmented on their own."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(_processor(model).serialized_model_proto())
    normal, trainer = proto.normalizer_spec, proto.trainer_spec
    return (
        trainer.model_type == trainer.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
        and normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
        and not normal.precompiled_charsmap and not proto.denormalizer_spec.precompiled_charsmap
        and not any(p.type == p.USER_DEFINED or re.search(f"[^{_MARK}]{_MARK}", p.piece) for p in proto.pieces)
    )


# A run of markers or spaces with what follows; the text stands behind one space.
_CHUNK = re.compile(f"[ {_MARK}]+[^ {_MARK}]*")


class ChunkTable:
    """``chunk -> (ids as bytes, decoded text)`` for the chunks of a task."""

    def __init__(self, model: str):
        self.processor = _processor(model)
        self.known: dict[str, tuple[bytes, str]] = {}
        # A marker with nothing behind it cannot be asked for alone: the library would add its own.
        lone = self.processor.encode("a ")[len(self.processor.encode("a")) :]
        self.lone = np.array(lone, "<u4").tobytes(), " "

    def _segment(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        # The library puts one marker before each text it is given: leave out ours.
        ids = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        texts = self.processor.decode(ids, num_threads=1)
        # Decoding takes the first marker off again, which inside a text is a space.
        return [(np.array(i, "<u4").tobytes(), " " + t) if i else self.lone for i, t in zip(ids, texts)]

    def encode(self, text: str) -> tuple[bytes, str]:
        if not text:
            return b"", ""
        chunks = _CHUNK.findall(" " + text)
        known = self.known
        missing = list({c for c in chunks if c not in known})
        if len(known) + len(missing) > TABLE_CHUNKS:
            known.clear()
            missing = list(set(chunks))
        once: dict[str, tuple[bytes, str]] = {}
        for at in range(0, len(missing), _LIST):
            some = missing[at : at + _LIST]
            for chunk, made in zip(some, self._segment(some)):
                (known if len(chunk) <= TABLE_BYTES and len(known) < TABLE_CHUNKS else once)[chunk] = made
        found = [known.get(c) or once[c] for c in chunks] if once else [known[c] for c in chunks]
        return b"".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]


def encode(
    df: DataFrame, model: str, text_col: str = "text", carry: list[str] | None = None, keep: bool = True,
) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``n_tokens``, digests of ids and of the decoded text.

    Ids have begin and end marks around them and are exact to the library's, as is
    the decoded text. With ``keep`` the ids and the decoded text are columns too. A null
    text is empty: two ids, decoded to nothing. Repeated rows repeat; an empty
    table gives no rows. The model file must be readable at this path in every task.
    """
    split = splits_at_markers(model)
    extra = ", ids array<int>, decoded string" if keep else ""

    def start():
        processor, table = _processor(model), ChunkTable(model)
        begin = np.array([processor.bos_id()], "<u4").tobytes()
        end = np.array([processor.eos_id()], "<u4").tobytes()

        def whole(text: str) -> tuple[bytes, str]:
            ids = processor.encode(text)
            return np.array(ids, "<u4").tobytes(), processor.decode(ids)

        def work(texts: Texts, _rows):
            one = table.encode if split else whole
            made = [one(t.decode()) for t in texts.rows()]
            marked = [begin + ids + end for ids, _ in made]
            out = [
                pa.array([len(m) // 4 for m in marked], pa.int64()),
                pa.array([hashlib.sha256(m).hexdigest() for m in marked]),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in made]),
            ]
            if keep:
                limits = np.cumsum([0, *[len(m) // 4 for m in marked]]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(marked), "<u4").view("<i4"))
                out += [pa.ListArray.from_arrays(pa.array(limits), values), pa.array([t for _, t in made], pa.string())]
            return out

        return work

    fields = f"n_tokens long, ids_sha256 string, decoded_sha256 string{extra}"
    return map_texts(df, text_col, carry or ["doc_id"], fields, start)
