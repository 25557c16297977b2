"""Tokenizer output: of short pieces, remembered per Python worker, or of whole texts.

Where a tokenizer provably never joins what stands on both sides of a
boundary, a text's tokens are those of its pieces one after the other. Words
repeat, so most pieces come from memory and only new ones are encoded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import numpy as np

#: Bound of the memory: pieces kept in each of two generations per worker (about
#: 80 MB together). A full generation becomes the older one and what is asked
#: for again moves on from it, so frequent pieces stay. Speed only.
KEPT_PIECES = 200_000

MARKS = (".", ",")

#: Longer pieces are encoded but not kept.
KEPT_CHARS = 64

# A space with something else on both sides. The byte-level pattern takes such
# a space together with what follows it, never with what precedes it.
SINGLE_SPACE = re.compile(r"(?<=[^ ])(?= [^ ])")

# The split of byte-level vocabularies, and the characters that stand
# for bytes in their files: those that print, then one after the other from 256.
BYTE_LEVEL_SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

_loaded: dict[str, object] = {}


def tokenizer(name: str):
    """The tokenizer of a vocabulary file, once per worker."""
    if name not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        import public_tokenizers
        from tokenizers import Tokenizer

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        _loaded[name] = Tokenizer.from_file(path)
        _loaded[name].no_truncation()
        _loaded[name].no_padding()
    return _loaded[name]


def space_pieces(text: str) -> list[str]:
    """Pieces for byte-level BPE; joined they are the text."""
    if "  " in text:
        return SINGLE_SPACE.split(text)
    head, *rest = text.split(" ")
    return [head, *[" " + x for x in rest]]


def word_pieces(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space: no token spans a space."""
    return text.replace("\n", " ").split(" ")


class Memory:
    """``keep(ids)`` of each piece, e.g. their number or their bytes; it adds up."""

    def __init__(self, encoder, keep: Callable[[list[int]], object]):
        self.encoder, self.keep = encoder, keep
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def of(self, pieces: Iterable[str]) -> dict[str, object]:
        """A mapping that holds every one of ``pieces``."""
        if len(self.known) > KEPT_PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        asked = {p for p in pieces if p not in known}
        known.update((p, older[p]) for p in asked & older.keys())
        new = {p for p in asked if p not in known}
        if not new:
            return known
        # A point or comma after a letter is a token of its own: such a piece
        # is made of its word, which is known more often. ASCII letters only: a
        # tokenizer may turn another into a letter and a mark that the point joins.
        ended = {
            p: p[:-1] for p in new
            if p[-1:] in MARKS and p[-2:-1].isascii() and p[-2:-1].isalpha()
        }
        parts = {*ended.values(), *MARKS} if ended else set()
        known.update((p, older[p]) for p in parts & older.keys())
        whole = list({p for p in (new - ended.keys()) | parts if p not in known})
        found = self.encoder.encode_batch_fast(whole, add_special_tokens=False)
        fresh = {p: self.keep(e.ids) for p, e in zip(whole, found, strict=True)}
        for p, word in ended.items():
            word, mark = (fresh[x] if x in fresh else known[x] for x in (word, p[-1]))
            fresh[p] = word + mark
        known.update((p, x) for p, x in fresh.items() if len(p) <= KEPT_CHARS)
        long = {p: x for p, x in fresh.items() if len(p) > KEPT_CHARS}
        return known | long if long else known


_memories: dict[tuple[str, str], object] = {}


def memory(name: str, kept: str, keep: Callable[[list[int]], object]) -> Memory:
    """The worker's memory of a vocabulary, which outlives a task; ``kept`` names ``keep``."""
    if (name, kept) not in _memories:
        _memories[name, kept] = Memory(tokenizer(name), keep)
    return _memories[name, kept]


class ByteEncoder:
    """Token ids of whole texts by a byte-level vocabulary, as its library gives them.

    Merging neighbours by the least id of what they make is several times faster
    than merging by a list, and the same where ids rise along the list and each
    token is what its own bytes are merged to: the state of those bytes when a
    token's turn comes is then its listed pair. Both are checked; a vocabulary of
    another kind is left to its library.
    """

    def __init__(self, encoder):
        self.encoder, self.fast = encoder, _by_ranks(encoder)

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def _by_ranks(encoder):
    """The vocabulary as ranks of byte strings; None if that isn't the same."""
    import tiktoken

    made = json.loads(encoder.to_str())
    split, model, added = made["pre_tokenizer"] or {}, made["model"], made["added_tokens"]
    plain = made["normalizer"] is None and split.get("type") == "ByteLevel"
    plain = plain and split["use_regex"] and not split["add_prefix_space"] and model["type"] == "BPE"
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
           "byte_fallback", "ignore_merges")
    if not plain or any(model.get(k) for k in odd):
        return None
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        return None
    vocabulary, byte_of = model["vocab"], {chr(b): b for b in PRINTED}
    rest = [b for b in range(256) if b not in PRINTED]
    byte_of.update((chr(256 + k), b) for k, b in enumerate(rest))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = ["".join(p) for p in pairs]
    ids = [vocabulary[t] for t in merged]
    special = {t["content"]: t["id"] for t in added}
    whole = len(ids) + 256 == len(vocabulary.keys() - special.keys())
    if not whole or any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return None
    if any([t.id for t in encoder.model.tokenize(x)] != [k] for x, k in zip(merged, ids, strict=True)):
        return None
    ranks = {bytes(byte_of[c] for c in t): k for t, k in vocabulary.items() if t not in special}
    return tiktoken.Encoding(
        "byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special
    )


def byte_encoder(name: str) -> ByteEncoder:
    """The worker's encoder of a vocabulary, which outlives a task."""
    if (name, "ranks") not in _memories:
        _memories[name, "ranks"] = ByteEncoder(tokenizer(name))
    return _memories[name, "ranks"]
