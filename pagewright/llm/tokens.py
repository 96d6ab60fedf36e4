"""Token ids of a byte-level BPE, whole pre-tokens remembered; exactly the ids of the tokenizer itself."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from pathlib import Path

import numpy as np

MOST_REMEMBERED = 400_000
_PLAIN = 0x250  # below it, the character classes are the same in every version of Unicode


def _chars(kinds: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN) if unicodedata.category(chr(c))[0] in kinds)


#: The pre-tokens of a byte-level BPE (fixed pattern), with the classes of letters and numbers written out.
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0"
PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_chars('L')}]+| ?[{_chars('N')}]+| ?[^{_SPACE}{_chars('LN')}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Texts with characters beyond those, or with the beginning of a special token's name, go to the tokenizer whole.
_BEYOND = re.compile(r"[^\x00-ɏ]")


def _unusual(text: str) -> bool:
    if "<|" in text:
        return True
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _BEYOND.search(text) is not None
    return False


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(other)}


class _Known(dict):
    """Ids of pre-tokens, worked out when first asked for; emptied when it holds too many."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MOST_REMEMBERED:
            self.clear()
        self[piece] = ids = np.array(self.encode(piece), "<u2").tobytes()
        return ids


class Encoder:
    """ids(text) as little-endian unsigned 16-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has over 65,536 ids")
        self.known = _Known(self._fast(path) or self._encode)

    @staticmethod
    def _fast(path: str):
        """The same merges in tiktoken, which works a piece out faster; None if the vocabulary isn't numbered by merges."""
        import tiktoken

        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab, chars = model["vocab"], _byte_chars()
        if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
            return None
        ranks = {bytes(chars[c] for c in token): k for token, k in vocab.items() if k < 256 + len(pairs)}
        return tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        if _unusual(text):
            return np.array(self._encode(text), "<u2").tobytes()
        return b"".join(map(self.known.__getitem__, PRE_TOKEN.findall(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
