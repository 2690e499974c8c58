"""Token ids of a public tokenizer, with a bounded cache of word ids per worker."""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters for which splitting and lower-casing here and in the library agree.
_OTHER = re.compile("[^\t-\r -~À-ÖØ-öø-ÿŒœ]")
_LETTER = "a-zß-öø-ÿœ"
#: The split of the lower-cased words tokenizer (fixed values of its vocabulary file).
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")
CACHE = 1 << 19


class WordTokenizer:
    """Ids of whole texts as little-endian 32-bit bytes.

    Ordinary texts are split into words here and only words not seen before go to
    the library; texts with other characters or special tokens go there whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        known, out = self.known, []
        for text in texts:
            if "<|" in text or _OTHER.search(text):
                out.append(self._whole([text])[0])
                continue
            pieces = _PIECE.findall(text.lower())
            try:
                out.append(b"".join(map(known.__getitem__, pieces)))
            except KeyError:
                new = [p for p in dict.fromkeys(pieces) if p not in known]
                known.update(zip(new, self._whole(new)))
                out.append(b"".join(map(known.__getitem__, pieces)))
        return out


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
