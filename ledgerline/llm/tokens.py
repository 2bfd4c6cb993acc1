"""Token ids and token counts of whole texts by the vocabulary files of public tokenizers.

Both tokenizers here never join characters across the cuts made below, so
the tokens of a text are those of its pieces, one after the other, and a piece
seen before needs no second encoding.  The store of seen pieces is emptied
when it is full; that costs time only.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .stores import store

ROOM = 125_000
#: Characters with the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def coder(kind: type, path: str):
    """The coder of this worker process for a vocabulary file."""
    return store((kind.__name__, path), lambda: kind(path))


#: With A-Z lowered: a-z, U+00C0-U+00FF without its two signs, U+0100-U+017F without U+0130, which is lowered to two characters.
_LETTER = r"a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}"
_SIGN = r"!-/:-@\[-`{-~"


def _byte_letters() -> dict[int, str]:
    """The characters in which byte-level vocabularies write bytes: printable ones as they are, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class WordIds:
    """Ids of a lower-casing BPE tokenizer that drops white space and marks the ends of words.

    The unit is a word between ASCII white space, taken once for a batch.  A
    word of Latin letters, ASCII digits and signs is cut into parts as the
    tokenizer itself cuts it, and only parts not seen before go through its
    merges.  Any other word, and one that might hold a special token, is a part
    marked with a leading NUL and goes through the whole tokenizer as it is.
    """

    PLAIN = f"^[{_LETTER}0-9{_SIGN}]+$"
    PART = f"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[{_SIGN}]+)"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = _tokenizer(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        vocabulary = self.merges.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.written = _byte_letters()
        self.seen: dict[str, bytes] = {"": b""}

    def _learn(self, parts: list[str]) -> None:
        odd = [p for p in parts if p[0] == "\0"]
        plain = [p for p in parts if p[0] != "\0"]
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            said = [p if p.isascii() else p.lower().encode().decode("latin-1").translate(self.written) for p in some]
            ids = np.array(self.merges.encode_batch_fast(["\n".join(said)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                raise ValueError("the vocabulary doesn't mark the ends of words")
            data, begin = ids.tobytes(), 0
            for p, stop in zip(some, (4 * stops).tolist(), strict=True):
                self.seen[p] = data[begin:stop]
                begin = stop
        found = self.tokenizer.encode_batch_fast([p[1:] for p in odd], add_special_tokens=False)
        self.seen.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(odd, found, strict=True))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and the last one's end."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        raw = coded.dictionary
        low = pc.ascii_lower(raw)
        plain = pc.and_not(pc.match_substring_regex(low, self.PLAIN), pc.match_substring(raw, "<|"))
        plain = pc.or_(plain, pc.equal(raw, ""))
        cut = pc.ascii_rtrim_whitespace(pc.replace_substring_regex(low, self.PART, r"\1 "))
        parts = pc.ascii_split_whitespace(pc.if_else(plain, cut, pc.binary_join_element_wise("\0", raw, "")))
        part = parts.flatten().dictionary_encode()
        distinct = part.dictionary.to_pylist()
        if len(self.seen) > ROOM:
            self.seen = {"": b""}
        self._learn([p for p in distinct if p not in self.seen])
        said = [self.seen[p] for p in distinct]
        pool = np.frombuffer(b"".join(said), "<u4")
        of_word, word_at = _gathered(pool, np.fromiter(map(len, said), np.int64, len(said)) // 4, part, parts)
        return _gathered(of_word, np.diff(word_at), coded, words)


def _gathered(pool: np.ndarray, length: np.ndarray, coded: pa.DictionaryArray, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For lists of codes: the pool's stretches of all codes in a row, and where each list's begin."""
    code = coded.indices.to_numpy()
    begin, size = np.cumsum(length) - length, length[code]
    ends = np.concatenate(([0], np.cumsum(size)))
    found = pool[np.arange(ends[-1]) + np.repeat(begin[code] - ends[:-1], size)]
    at = lists.offsets.to_numpy()
    return found, ends[at - at[0]]


def _sums(values: np.ndarray, coded: pa.DictionaryArray, lists: pa.Array) -> np.ndarray:
    """For lists of codes: the sum of each list's values."""
    ends = np.concatenate(([0], np.cumsum(values[coded.indices.to_numpy()])))
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return ends[at[1:]] - ends[at[:-1]]


class SpacedCounts:
    """Token counts of a byte-level BPE tokenizer whose parts may begin with one space.

    In a text whose words are divided by single spaces or line feeds the units
    are `` word`` and ``LF word``, taken once for a batch; a unit of Latin letters,
    digits and signs is cut into parts as the tokenizer itself cuts it, any other
    goes through the whole tokenizer.  Other texts are cut at white space by the
    tokenizer's own rule, one after the other.
    """

    LETTER = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17F}"
    PLAIN = f"^[ \n]?[{LETTER}0-9{_SIGN}]+$"
    PART = f"('s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[{_SIGN}]+|\n)"
    IRREGULAR = (
        r"[\t\v\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
        r"|[ \n][ \n]|^[ \n]|[ \n]$"
    )
    #: The tokenizer's own cuts at white space; letters, digits and signs stay together here.
    CUT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = _tokenizer(path)
        self.tokenizer.encode_special_tokens = True
        self.merges = Tokenizer(self.tokenizer.model)
        self.written = _byte_letters()
        self.whole: dict[str, int] = {}
        self.parts: dict[str, int] = {"": 0}

    def _known(self, store: dict[str, int], wanted: list[str], encode) -> list[int]:
        if len(store) > 2 * ROOM:
            store.clear()
            store[""] = 0
        new = [x for x in wanted if x not in store]
        if new:
            store.update((x, len(e)) for x, e in zip(new, encode(new), strict=True))
        return [store[x] for x in wanted]

    def _of_parts(self, parts: list[str]):
        return self.merges.encode_batch_fast(
            [p.encode().decode("latin-1").translate(self.written) for p in parts], add_special_tokens=False
        )

    def _of_whole(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _one(self, text: str) -> int:
        return sum(self._known(self.whole, self.CUT.findall(text), self._of_whole))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        texts = pc.fill_null(texts, "")
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.IRREGULAR).to_numpy(zero_copy_only=False))
        filled = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
        # a line feed in front makes the first unit one like others; it is a token of its own
        texts_ = pc.binary_join_element_wise("\n", texts, "")
        units = pc.split_pattern(pc.replace_substring(texts_, "\n", " \n"), " ")
        coded = units.flatten().dictionary_encode()
        said = coded.dictionary
        unit = pc.if_else(pc.starts_with(said, "\n"), said, pc.binary_join_element_wise(" ", said, ""))
        unit = pc.if_else(pc.equal(said, ""), "", unit)  # what stands before the first line feed
        plain = pc.match_substring_regex(unit, self.PLAIN)
        cut = pc.split_pattern(pc.replace_substring_regex(pc.if_else(plain, unit, ""), self.PART, "\\1\0"), "\0")
        part = cut.flatten().dictionary_encode()
        of_part = np.array(self._known(self.parts, part.dictionary.to_pylist(), self._of_parts), np.int64)
        of_unit = _sums(of_part, part, cut)
        rest = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        of_unit[rest] = self._known(self.whole, unit.take(pa.array(rest)).to_pylist(), self._of_whole)
        total = (_sums(of_unit, coded, units) - 1) * filled
        for i in odd.tolist():
            total[i] = self._one(texts[i].as_py())
        return total
