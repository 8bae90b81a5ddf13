"""Public SentencePiece vocabularies: the file is read once on the driver and its bytes travel with the task."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cached_property

import sentencepiece

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """A piece vocabulary (pickled as the model's bytes, a fixed size of about 0.5 MB)."""

    model: bytes

    @classmethod
    def load(cls, path: str = PIECE_MODEL) -> Vocabulary:
        with open(path, "rb") as f:
            return cls(f.read())

    def __getstate__(self):
        return {"model": self.model}

    def __setstate__(self, state):
        object.__setattr__(self, "model", state["model"])

    @cached_property
    def key(self) -> int:
        return zlib.crc32(self.model)

    @cached_property
    def processor(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def byte_ids(self) -> list[int]:
        """Id of each byte's fallback piece; -1 where the vocabulary has none."""
        out = [-1] * 256
        for i in range(self.processor.get_piece_size()):
            if self.processor.is_byte(i):
                out[int(self.processor.id_to_piece(i)[3:5], 16)] = i
        return out
