"""Public vocabularies as encoders: texts to token ids, and the bytes that each id stands for."""

from __future__ import annotations

import json
import re

from gridlake.llm import common as C

#: Characters of a piece of a long text.
PIECE_CHARS = 500_000
#: Before a single space between two ASCII letters no token of either vocabulary goes across.
CUT = re.compile(r"(?<=[a-z])(?= [a-z])", re.IGNORECASE | re.ASCII)
# --- Fixed values: the public split pattern of byte-level BPE, and how it writes bytes
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
# -----------------------------------------------------------------------------


def byte_of_character() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for characters from 256 on."""
    shown = [b for low, high in PRINTABLE for b in range(low, high + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Texts -> token ids by a byte-level BPE file, special tokens' strings being plain text;
    ``spell``: the bytes of each id. Where the file's merges come in the order of their ids, as in
    public vocabularies, an id is its own merge rank and the rank encoder is used, which is some
    times as fast as the file's own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, byte = told["model"], byte_of_character()
        special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        entries = {e: i for e, i in model["vocab"].items() if e not in special}
        self.spell = [b""] * (max([*entries.values(), *special.values()]) + 1)
        for entry, i in entries.items():
            self.spell[i] = bytes(byte[c] for c in entry)
        for entry, i in special.items():
            self.spell[i] = entry.encode()
        made = [entries[a + b] for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        plain = told.get("normalizer") is None and told["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
        }
        self.ranks = plain and len(made) + 256 == len(entries) and all(i < j for i, j in zip(made, made[1:]))
        if self.ranks:
            import tiktoken

            self.model = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks={self.spell[i]: i for i in entries.values()}, special_tokens={})
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranks:
            return [self.model.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Texts -> token ids by a piece model with byte fallback, which puts a space first."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spell = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.spell.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("\u2581", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def pieces_of(text: str) -> list[str]:
    """A text in parts that can be encoded alone; all but the first begin with their space."""
    parts, start = [], 0
    while len(text) - start > PIECE_CHARS:
        found = CUT.search(text, start + PIECE_CHARS)
        if found is None:
            break
        parts.append(text[start : found.start()])
        start = found.start()
    return [*parts, text[start:]]


C.ship(__name__)
