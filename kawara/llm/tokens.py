"""Token ids and token counts under a published byte-level vocabulary.

The vocabulary stays where it was installed; workers load it by name, once per process.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
#: What other white space than a space and a line feed a text may hold, as Python or the vocabulary's pattern sees it.
OTHER_SPACE = tuple(
    map(chr, (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
CACHE = 300_000
#: Characters of a word that is kept; of text without spaces a word is a whole line.
LONGEST = 64


@lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY):
    """The vocabulary in the fast library; the same ids as its .json file gives."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
    return tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
    )


def ids_of(text: str | None, name: str = VOCABULARY) -> np.ndarray:
    """Ids as unsigned 32-bit numbers; the special string inside a text is its special id."""
    e = encoder(name)
    if not text:
        return np.empty(0, np.uint32)
    return np.asarray(e.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)


def regular(text: str) -> bool:
    """Whether all white space is single spaces and line feeds between other characters.

    The pattern then never joins characters across such a place: a space opens the word that
    follows it and a line feed is a piece of its own, so counts of the words add up.
    """
    return not (
        "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or text[:1] in " \n"
        or text[-1:] in " \n"
        or SPECIAL in text
        or any(c in text for c in OTHER_SPACE)
    )


class Lengths(dict):
    """Word -> number of tokens: frequent words given, the others encoded once and cached.

    ``lead`` stands before the word when it is encoded. The cache is emptied down to the frequent
    words when full and long words are not kept, so its size is bounded.
    """

    def __init__(self, frequent: dict[str, int], lead: str, encode, limit: int = CACHE):
        super().__init__(frequent)
        self.frequent, self.lead, self.encode, self.limit = frequent, lead, encode, limit

    def __missing__(self, word: str) -> int:
        value = len(self.encode(self.lead + word))
        if len(word) <= LONGEST:
            if len(self) >= self.limit + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[word] = value
        return value
