"""Byte-level BPE through a sentencepiece model that is written from the vocabulary, not trained.

A vocabulary of ranks (token bytes, rank) becomes a BPE model: every byte is mapped to a printable character, a token to
the piece of its mapped bytes, and a piece's score is its negative rank, so that the best-scored merge is the one of the
lowest rank. Normalisation is the identity, and no blank is added, removed or escaped. Texts are cut by the pattern of
the vocabulary, each match is mapped, encoded by the model and its pieces become ranks; decoding joins the pieces of the
ids and maps their characters back to bytes. Tokens that no chain of merges reaches are known when the model is
written and are taken whole if a match is equal to one, as a lookup of the match before merging does.

Null and empty texts have no ids, and no ids are no bytes. Texts are encoded whole, however long they or their matches are.
Repeated rows and ids stay as they are; other columns are not carried, whatever their names; an empty table gives an empty result. Null ids
decode to null; an id that is not in the vocabulary is an error.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from revlens.llm.common import one_by_one, pieces, texts

UNKNOWN = ""
# Remembered matches of a worker: at most this many, none longer than the second number of characters.
MEMORY, LONGEST = 1 << 18, 40


def byte_characters() -> dict[int, int]:
    """A printable character for every byte: itself where Latin-1 prints it, else the next of those from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in own else next(others) for b in range(256)}


CHARACTERS = byte_characters()
BYTES = {c: b for b, c in CHARACTERS.items()}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(CHARACTERS)


def unmapped(piece: str) -> bytes:
    return piece.translate(BYTES).encode("latin-1")


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def serialised(ranks: dict[bytes, int]) -> bytes:
    """The model file of a vocabulary: pieces by rank, then the unknown piece, which no text of bytes in the vocabulary meets."""
    model = sentencepiece_model_pb2.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda pair: pair[1]):
        model.pieces.add(piece=mapped(token), score=-rank, type=sentencepiece_model_pb2.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece=UNKNOWN, score=0, type=sentencepiece_model_pb2.ModelProto.SentencePiece.UNKNOWN)
    trainer, normaliser = model.trainer_spec, model.normalizer_spec
    trainer.model_type = sentencepiece_model_pb2.TrainerSpec.BPE
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(ranks), -1, -1, -1
    normaliser.name = "identity"
    normaliser.add_dummy_prefix = normaliser.remove_extra_whitespaces = normaliser.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes texts and decodes ids by a serialised model and its ranks."""

    def __init__(self, model: bytes, ranks: list[int], whole: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.processor = SentencePieceProcessor(model_proto=model)
        self.ranks, self.whole, self.find = ranks, whole, regex.compile(pattern).findall
        self.remembered: dict[str, bytes] = {}
        self.bytes: dict[int, bytes] = {}

    @staticmethod
    def parts(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN) -> tuple[bytes, list[int], dict[bytes, int], str]:
        """What a codec is made of, small and fixed by the vocabulary, so that it can travel to the tasks."""
        model, order = serialised(ranks), sorted(ranks.values())
        alone = SentencePieceProcessor(model_proto=model).encode([mapped(token) for token in ranks])
        whole = {token: rank for (token, rank), found in zip(ranks.items(), alone, strict=True) if len(found) != 1}
        return model, order, whole, pattern

    def learn(self, matches: list[str]) -> dict[str, bytes]:
        """The ids of matches, as bytes of 32-bit numbers."""
        out, ranks = {}, self.ranks
        for match, found in zip(matches, self.processor.encode([m.encode().decode("latin-1").translate(CHARACTERS) for m in matches], num_threads=1), strict=True):
            if max(found) >= len(ranks):
                raise ValueError("the vocabulary lacks a byte of the text")
            out[match] = array("i", [ranks[place] for place in found]).tobytes()
        for match in matches if self.whole else ():
            if match.encode() in self.whole:
                out[match] = array("i", [self.whole[match.encode()]]).tobytes()
        return out

    def ids(self, some: list[str]) -> list[np.ndarray]:
        """The ids of some texts, whose unknown matches are encoded together."""
        matches = [self.find(text) for text in some]
        known = self.remembered
        new = self.learn([match for match in set().union(*matches) if match not in known])
        long = {match: ids for match, ids in new.items() if len(match) > LONGEST}
        if not long:
            known.update(new)
            new = known
        else:
            new = {**new, **{match: known[match] for match in set().union(*matches) if match in known}}
            known.update((match, ids) for match, ids in new.items() if match not in long)
        out = [np.frombuffer(b"".join(map(new.__getitem__, found)), np.int32) for found in matches]
        if len(known) > MEMORY:
            known.clear()
        return out

    def parts_of(self, ids: list[int]) -> list[bytes]:
        """The bytes of each id."""
        if not self.bytes:
            self.bytes = {rank: unmapped(self.processor.id_to_piece(place)) for place, rank in enumerate(self.ranks)}
        return list(map(self.bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.parts_of(ids))


def multi_50k() -> dict[bytes, int]:
    """The byte-level vocabulary of 50,256 ranks for many languages."""
    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", key: str = "doc_id", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The key and `ids`, the ranks of the text's tokens in order, of every row."""
    parts = docs.sparkSession.sparkContext.broadcast(Codec.parts(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*parts.value)
        for batch in one_by_one(batches):
            column = texts(batch.column(1))
            for start, stop in pieces(column):
                found = codec.ids(column.slice(start, stop - start).to_pylist())
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), ids], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """The table with `decoded`, the bytes that the ids stand for, in place of a column of that name."""
    parts = encoded.sparkSession.sparkContext.broadcast(Codec.parts(ranks))
    carried = encoded.drop("decoded")
    names = [*carried.columns, "decoded"]
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*parts.value)
        for batch in one_by_one(batches):
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                column = some.column(place)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
                bits = codec.parts_of(column.flatten().to_numpy(zero_copy_only=False).tolist())
                found = [b"".join(bits[begin:end]) if there else None for begin, end, there in zip([0, *ends], ends, column.is_valid().to_pylist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.binary())], names=names)

    return carried.mapInArrow(run, carried.withColumn("decoded", F.lit(None).cast("binary")).schema)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256 of every document."""
    both = decode(encode(docs, ranks, text), ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
