"""Encoding with the ``tokenizers`` library, once per distinct chunk of a block."""

from __future__ import annotations

import os
import re

import numpy as np

from chronoweave.llm.blocks import ChunkCache

#: The split of byte-level vocabularies for code points under 256, where the library's pattern and this one agree (fixed values).
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_DIGITS = "0-9²³¹¼-¾"
_BLANKS = "\t-\r \u0085 "
_SPLITS = {
    "bytes": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| "
        f"?[^{_BLANKS}{_LETTERS}{_DIGITS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"),
    "words": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+"),
}


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Stands between pieces while their bytes are spelled; its code point is over 255, so no piece holds it, and UTF-8 is self-synchronizing.
_SEPARATOR = "\u2063"


class ChunkEncoder(ChunkCache):
    """Encodes distinct chunks with the model of a tokenizer file.

    Chunks of code points under 256 are split here and their pieces go to the library's model in one call; any other chunk, and one
    that holds the text of an added token, goes through the whole tokenizer, which gives that token its own id.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare = Tokenizer(self.tokenizer.model)
        self.words = self.tokenizer.normalizer is not None
        self.split = _SPLITS["words" if self.words else "bytes"]
        self.letters = _byte_letters()
        self.mark = _SEPARATOR.encode().decode("latin-1").translate(self.letters)

    def encode_new(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[str] = []
        counts = np.zeros(len(chunks), dtype=np.int64)
        others: dict[int, list[int]] = {}
        findall = self.split.findall
        for i, chunk in enumerate(chunks):
            text = chunk.decode("utf-8", "replace")
            if not (text.isascii() or max(text) < "\u0100") or any(token in chunk for token in self.added):
                others[i] = self.tokenizer.encode(text, add_special_tokens=False).ids
                continue
            if self.words:
                text = text.lower()
                text = text[1:] if text[:1] == " " else text
            if text[text[:1] == " " :].isalpha():
                pieces.append(text)
                counts[i] = 1
            else:
                found = findall(text)
                pieces += found
                counts[i] = len(found)
        lengths = np.zeros(len(chunks), dtype=np.int64)
        flat = np.zeros(0, dtype=np.int32)
        if pieces:
            spelled = _SEPARATOR.join(pieces).encode().decode("latin-1").translate(self.letters).split(self.mark)
            encoding = self.bare.encode(spelled, is_pretokenized=True, add_special_tokens=False)
            flat = np.array(encoding.ids, dtype=np.int32)
            sizes = np.bincount(np.array(encoding.word_ids, dtype=np.int64), minlength=len(pieces))
            sums = np.concatenate([[0], np.cumsum(sizes)])
            ends = np.cumsum(counts)
            lengths = sums[ends] - sums[ends - counts]
        if not others:
            return flat, lengths
        starts = np.cumsum(lengths) - lengths
        parts, at = [], 0
        for i, ids in others.items():
            parts += [flat[at : starts[i]], np.array(ids, dtype=np.int32)]
            at = starts[i]
            lengths[i] = len(ids)
        return np.concatenate([*parts, flat[at:]]), lengths
