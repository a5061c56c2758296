"""Token counts of a byte-level BPE for every prefix of a text, by dynamic programming over prefixes.

A sequence of BPE tokens is the encoding of its text exactly when every two
neighbours encode to themselves. So the encoding of a prefix is the encoding of
a shorter prefix plus the one token that may follow its last token, and

    count[j] = count[i] + 1,   where piece[i:j] may follow the last token of piece[:i]

gives the count at every prefix of a pre-token in one pass. Texts are cut between
a character that is not white space and one that is: no pre-token crosses such a
place, so counts of the parts add up and are kept by part in each worker.

``prefix_counts`` stores the count at every prefix of a text; ``truncate`` and ``budget``
answer from what is stored, without encoding anything again.

Null and empty texts have no bytes and no tokens. Special strings inside texts
count as one token, as in the tokenizer's default. Input columns with the name of
an output column are replaced.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import add_columns, field, kept, quoted

#: Parts whose counts a worker keeps; the store is emptied when it is full.
KEPT_PARTS = 800_000
#: White space for str but not for the tokenizers' patterns.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile(r"[^\S\x1c-\x1f]*")
_PARTS = re.compile(r"\s*\S+|\s+")


class PrefixCounter:
    """Exact token counts at prefixes, for a tokenizers file with a byte-level BPE."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["model"]["type"] != "BPE":
            raise ValueError("a byte-level BPE without normaliser is needed")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings aren't supported")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.tokens = {a + b for a, b in pairs} | set(_byte_letters())
        self.longest = max(map(len, self.tokens))
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.joined: dict[tuple[str, str], bool] = {}
        self.alone: dict[str, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, int] = {}

    def _merged(self, text: str) -> list[str]:
        """Encoding by merges, used only on one or two tokens."""
        now, rank = list(text), self.rank
        while len(now) > 1:
            pair = min(zip(now, now[1:], strict=False), key=lambda p: rank.get(p, 1 << 60))
            if pair not in rank:
                break
            out, k = [], 0
            while k < len(now):
                if k + 1 < len(now) and (now[k], now[k + 1]) == pair:
                    out.append(now[k] + now[k + 1])
                    k += 2
                else:
                    out.append(now[k])
                    k += 1
            now = out
        return now

    def _may_begin(self, token: str) -> bool:
        if (known := self.alone.get(token)) is None:
            known = self.alone[token] = self._merged(token) == [token]
        return known

    def _may_follow(self, before: str, token: str) -> bool:
        key = (before, token)
        if (known := self.joined.get(key)) is None:
            if len(self.joined) > 4 * KEPT_PARTS:
                self.joined.clear()
            known = self.joined[key] = self._merged(before + token) == [before, token]
        return known

    def piece(self, piece: str) -> bytes | list[int]:
        """Token count of each prefix of one pre-token, given in byte letters."""
        if (known := self.pieces.get(piece)) is not None:
            return known
        counts, last = [0], [""]
        tokens, joined = self.tokens, self.joined
        for j in range(1, len(piece) + 1):
            for i in range(max(0, j - self.longest), j):
                token = piece[i:j]
                if token not in tokens:
                    continue
                if i:
                    fits = joined.get((last[i], token))
                    if fits is None:
                        fits = self._may_follow(last[i], token)
                else:
                    fits = self._may_begin(token)
                if fits:
                    counts.append(counts[i] + 1)
                    last.append(token)
                    break
        if len(piece) < 64:
            if len(self.pieces) >= KEPT_PARTS:
                self.pieces.clear()
            self.pieces[piece] = counts = bytes(counts)
        return counts

    def part(self, part: str) -> int:
        # a blank, letters and at most one stop are one or two pre-tokens by the pattern; others are split by the library
        mark = part[-1] in ".,"
        if part[1 : -1 if mark else None].isalpha() and part[0] == " ":
            word = part[:-1] if mark else part
            total = self.piece(word.encode().decode("latin-1").translate(_LETTERS))[-1] + mark
        else:
            total = sum(self.piece(p)[-1] for p, _ in self.split(part))
        if len(part) < 64:
            if len(self.parts) >= KEPT_PARTS:
                self.parts.clear()
            self.parts[part] = total
        return total

    def _plain_parts(self, text: str) -> list[str]:
        return [text] if _ODD_SPACE.search(text) else _PARTS.findall(text)

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text between special strings (False) and these (True)."""
        if self.special is None or not self.special.search(text):
            return [(text, False)]
        return [(s, bool(k % 2)) for k, s in enumerate(self.special.split(text)) if s]

    def count(self, text: str) -> int:
        total = 0
        known = self.parts.get
        for segment, special in self.segments(text):
            if special:
                total += 1
                continue
            parts = self._plain_parts(segment)
            counts = list(map(known, parts))
            if None in counts:
                counts = [self.part(p) if c is None else c for p, c in zip(parts, counts, strict=True)]
            total += sum(counts)
        return total

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token counts of text[:n] for n from 0 to its length."""
        out = [np.zeros(1, np.int32)]
        before, tail = 0, ""  # tokens before the last part, and that part: a cut special string joins it
        for segment, special in self.segments(text):
            if special:
                for n in range(1, len(segment)):
                    out.append(np.array([before + self.part(tail + segment[:n])], np.int32))
                before += (self.part(tail) if tail else 0) + 1
                tail = ""
                out.append(np.array([before], np.int32))
                continue
            for p in self._plain_parts(segment):
                before, tail = before + (self.part(tail) if tail else 0), p
                out.append(before + self._part_prefixes(p))
        return np.concatenate(out)

    def _part_prefixes(self, part: str) -> np.ndarray:
        """Counts of part[:n] for n from 1 on, read from the prefix counts of its pre-tokens.

        A prefix that ends inside a pre-token ends its encoding there. Two cuts change the pre-tokens: in white space, where
        the run up to the cut is one pre-token, and in a two-letter contraction, of which a mark and a letter are left.
        """
        out = np.zeros(len(part), np.int32)
        total = at = 0
        run, run_total = "", 0
        for piece, _ in self.split(part):
            raw = piece.translate(_BYTES).encode("latin-1")
            # characters end where the next byte begins one
            ends = np.flatnonzero((np.frombuffer(raw + b"a", np.uint8)[1:] & 0xC0) != 0x80) + 1
            counts = self.piece(piece)
            counts = np.frombuffer(counts, np.uint8) if isinstance(counts, bytes) else np.array(counts)
            n = len(ends)
            out[at : at + n] = total + counts[ends]
            text = part[at : at + n]
            if n == 3 and text[0] == "'" and text[1:].isalpha():
                out[at + 1] = total + 2
            blanks = len(_BLANKS.match(text)[0])
            if blanks:
                if not run:
                    run_total = total
                run += text[:blanks]
                letters = run.encode().decode("latin-1").translate(_LETTERS)
                own = self.piece(letters)
                for k in range(blanks):
                    out[at + k] = run_total + own[len(run[: len(run) - blanks + k + 1].encode())]
            if blanks < n:
                run = ""
            total += int(counts[-1])
            at += n
        if not run:
            out[-1] = total
        return out


def _byte_letters() -> list[str]:
    """The letters that stand for the 256 bytes: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) for b in plain] + [chr(256 + k) for k in range(len(rest))]


_BYTES = {ord(c): b for c, b in zip(_byte_letters(), [*(b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b), *(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b))], strict=True)}
_LETTERS = dict(zip([*(b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b), *(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b))], _byte_letters(), strict=True))


def counter(path: str) -> PrefixCounter:
    """One counter for each worker process; what it has learnt serves later tasks too."""
    return kept(f"counts {path}", lambda: PrefixCounter(path))


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with ``n_bytes`` and ``n_tokens`` (long) of each whole text."""

    def make():
        count = counter(tokenizer).count

        def step(texts: pa.Array):
            texts = texts.to_pylist()
            return [len(t.encode("utf-8", "surrogatepass")) for t in texts], [count(t) for t in texts]

        return step

    return add_columns(df, text, [field("n_bytes", "bigint"), field("n_tokens", "bigint")], make, drop_text)


def prefix_counts(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """df with ``prefix_tokens`` (array of int): the exact count of each prefix, of 0, 1, 2, ... characters."""

    def make():
        own = counter(tokenizer)

        def step(texts: pa.Array):
            each = [own.prefixes(t) for t in texts.to_pylist()]
            ends = np.cumsum([0, *map(len, each)])
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(each) if each else np.empty(0, np.int32)))]

        return step

    return add_columns(df, text, [field("prefix_tokens", "array<int>")], make)


def truncate(counted: DataFrame, limit: int, prefixes: str = "prefix_tokens") -> DataFrame:
    """counted (with stored prefix counts) with ``cut_chars`` and ``cut_tokens`` (int): the longest prefix within ``limit`` tokens, looked up.

    Counts may fall as a text grows (a merge takes letters in), so the last prefix within the limit is taken.
    """
    counts = F.col(quoted(prefixes))
    last = F.size(counts) - F.array_position(F.transform(F.reverse(counts), lambda n: n <= limit), True)
    return counted.withColumn("cut_chars", last.cast("int")).withColumn("cut_tokens", F.element_at(counts, (last + 1).cast("int")))


def budget(counted: DataFrame, chars: Column, prefixes: str = "prefix_tokens", name: str = "tokens_used") -> DataFrame:
    """counted with the tokens that its first ``chars`` characters take, looked up."""
    counts = F.col(quoted(prefixes))
    return counted.withColumn(name, F.element_at(counts, (F.least(F.greatest(chars, F.lit(0)), F.size(counts) - 1) + 1).cast("int")))
