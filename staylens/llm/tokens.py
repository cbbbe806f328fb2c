"""Token ids of whole texts with a public tokenizer file, as bytes.

The vocabulary at hand drops white space and never lets a token cross it, so the ids of a text are the
ids of its chunks between blanks and line feeds, one after the other. Words come again and again:
each worker keeps the ids of the chunks it has seen.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS_KEPT = 500_000
LONGEST_KEPT = 64
GROUP = 256
GROUP_BYTES = 4 << 20
WORD_END = "</w>"
MARKS = (b".", b",", b";", b":", b"!", b"?")


class ChunkTokenizer:
    """ids(texts) gives little-endian unsigned 32-bit ids per text. `path` is a file of the `tokenizers` library.

    Only for lower-case vocabularies whose pre-tokenizer removes white space and parts letters from
    punctuation; checked on construction.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        whole = self.tokenizer.encode(" \n A \n\n b, ", add_special_tokens=False).ids
        if whole != [i for part in self._encode([b"a", b"b", b","]) for i in np.frombuffer(part, "<u4").tolist()]:
            raise ValueError(f"{path} keeps white space or capitals")
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[bytes, bytes] = {b"": b""}

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters: many go through the library as one text, and end marks part them again."""
        texts = [b" ".join(words[i : i + GROUP]).decode() for i in range(0, len(words), GROUP)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids, dtype="<u4") for e in found]) if found else np.zeros(0, "<u4")
        ends = (4 * (np.flatnonzero(self.ends_word[flat]) + 1)).tolist()
        if len(ends) != len(words):
            return self._encode(words)
        raw = flat.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if words else []

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, new: set[bytes]) -> None:
        # A mark after a letter is a token of its own, so it needs no look at the word before it.
        marked = [c for c in new if c.endswith(MARKS) and c[-2:-1].isalpha()]
        plain = [*new.difference(marked).union(c[:-1] for c in marked).union(c[-1:] for c in marked).difference(self.known)]
        known = self.known
        words = [c for c in plain if c.decode().isalpha()]
        known.update(zip(words, self._encode_words(words), strict=True))
        other = [c for c in plain if c not in known]
        known.update(zip(other, self._encode(other), strict=True))
        known.update((c, known[c[:-1]] + known[c[-1:]]) for c in marked)

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text (UTF-8), in order."""
        if not texts:
            return
        # A chunk is looked up once in a group of texts, however often it comes.
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64) // GROUP_BYTES
        firsts = np.flatnonzero(np.diff(ends, prepend=-1)).tolist()
        for first, last in zip(firsts, [*firsts[1:], len(texts)], strict=True):
            lowered = pa.array([t.lower().replace(b"\n", b" ") for t in texts[first:last]], pa.large_binary())
            split = pc.split_pattern(lowered, " ")
            coded = split.flatten().dictionary_encode()
            chunks = coded.dictionary.to_pylist()
            if len(self.known) > WORDS_KEPT:
                self.known = {b"": b""}
            found = list(map(self.known.get, chunks))
            new = {chunks[i]: i for i, ids in enumerate(found) if ids is None}
            # Very long chunks are not kept.
            long = {c for c in new if len(c) > LONGEST_KEPT}
            self._learn(new.keys() - long)
            rare = dict(zip(long, self._encode([*long]), strict=True))
            for chunk, i in new.items():
                found[i] = rare[chunk] if chunk in rare else self.known[chunk]
            # The ids of the different chunks lie one after the other; each chunk of a text points to its own.
            flat = np.frombuffer(b"".join(found), "<u4")
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            which = coded.indices.to_numpy()
            lengths = sizes[which]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            shift = (np.cumsum(sizes) - sizes)[which] - starts[:-1]
            raw = flat[np.repeat(shift, lengths) + np.arange(starts[-1])].tobytes()
            cuts = (4 * starts[split.offsets.to_numpy()]).tolist()
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                yield raw[start:end]


@lru_cache(maxsize=2)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One per worker and file."""
    return ChunkTokenizer(path)


def word_vocabulary() -> str:
    """Place of the public vocabulary that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
