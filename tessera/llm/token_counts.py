r"""Token counts: batch encoding by a tokenizer library in an Arrow function that returns lengths only.

Texts go to the Python workers in Arrow batches, one 64-bit count comes back
for each; ids never leave the library. Inside a worker a text longer than
``PART_CHARS`` is split at safe boundaries into parts, and parts into words
(at the safe boundaries before white space); counts are added. Of the words of
a few hundred kilobytes of text, those not seen before go to the library, once
each, in calls balanced by bytes, not by rows: a call takes strings until
``BATCH_BYTES`` are reached, so memory for the library's results is bounded
whatever the lengths. Counts of short words are remembered.

A boundary is safe where the splitting pattern must end a match whatever
stands further left or right, so that the parts' matches are the text's
matches. For the byte-level pattern that is (1) before ASCII white space that
follows a character that is no white space: no alternative holds white space
behind another character, and the look-ahead of the white-space run is on its
right; (2) between a letter and a punctuation mark: no alternative holds a
non-letter behind a letter. A boundary inside a special string is not taken.
A stretch without a safe boundary stays whole, and so does a part with white
space beyond ASCII. Vocabularies with another splitting rule or with a
normaliser are encoded as whole texts.

Defined results: a null text counts as empty and has 0 bytes and 0 tokens;
repeated rows are counted row by row; an empty table gives no rows; other
columns pass through, one named as an output column is replaced.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_bytes

BATCH_BYTES = 1 << 18
PART_CHARS = 1 << 16
KNOWN_WORDS, KNOWN_CHARS = 600_000, 32

_LETTER = "A-Za-zぁ-ゖァ-ヺ一-龥가-힣"
_MARK = ".,;:!?、。！，？"
SPACED = re.compile(r"\s")
_WORD = re.compile("[\\t-\\r ]*[^\\t-\\r ]+|[\\t-\\r ]+")
# white space beyond ASCII, and characters that some engines count as such
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SAFE = re.compile(rf"(?<=\S)(?=[\t-\r ])|(?<=[{_LETTER}])(?=[{_MARK}])")


def parts(text: str, size: int, specials: tuple[str, ...] = ()) -> Iterator[str]:
    """Pieces of ``text`` of ``size`` characters or a little more, each cut at the next safe boundary."""
    start = 0
    while len(text) - start > size:
        cut, seek = len(text), start + size
        while found := SAFE.search(text, seek):
            if not any(_spans(text, found.start(), s) for s in specials):
                cut = found.start()
                break
            seek = found.start() + 1
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


def words(text: str) -> list[str]:
    """``text`` cut before every run of ASCII white space, where each such cut is a safe boundary; else whole."""
    return [text] if _OTHER_SPACE.search(text) else _WORD.findall(text)


def _spans(text: str, at: int, special: str) -> bool:
    """Whether an occurrence of ``special`` reaches over the boundary ``at``."""
    return text.find(special, max(0, at - len(special) + 1), at + len(special) - 1) >= 0


class Counter:
    """A tokenizer library's counts: ``many`` texts in one call; ``splits`` says whether parts may be added up."""

    def __init__(self, many: Callable[[list[str]], list[int]], splits: bool, specials: tuple[str, ...] = ()):
        self.many, self.splits, self.specials = many, splits, specials
        self.known: dict[str, int] = {}  # counts of short strings, at most KNOWN_WORDS and those of one batch

    @classmethod
    def of(cls, kind: str, raw: bytes) -> Counter:
        """From a vocabulary file's ending ("json" or "model") and bytes."""
        if kind == "json":
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
            library = Tokenizer.from_str(raw.decode())
            library.no_truncation()
            library.no_padding()
            made = json.loads(raw)
            split = made.get("pre_tokenizer") or {}
            byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True)
            whole = byte_level and not split.get("add_prefix_space") and not made.get("normalizer")
            added = made.get("added_tokens") or []
            plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or SPACED.search(t["content"]) for t in added)
            return cls(lambda texts: [len(e) for e in library.encode_batch(texts, add_special_tokens=False)],
                       bool(whole and plain), tuple(t["content"] for t in added))
        if kind == "model":
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_proto=raw)
            return cls(lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], splits=False)
        raise ValueError(f"no tokenizer library for a .{kind} file")

    def counts(self, texts: list[str | None], sizes: list[int], batch_bytes: int, part_chars: int) -> list[int]:
        """Token count of each text; ``sizes`` are their bytes."""
        if not self.splits:
            return self._sums([[t] if t else [] for t in texts], batch_bytes)
        found = [0] * len(texts)
        start, held, pieces = 0, 0, []
        for i, (text, size) in enumerate(zip(texts, sizes)):
            for part in parts(text, part_chars, self.specials) if text and len(text) > part_chars else [text or ""]:
                pieces.append((i, words(part)))
                held += size * len(part) // max(1, len(text or ""))
                if held > 4 * batch_bytes:
                    self._add(found, pieces, batch_bytes)
                    pieces, held = [], 0
        self._add(found, pieces, batch_bytes)
        return found

    def _add(self, found: list[int], pieces: list[tuple[int, list[str]]], batch_bytes: int) -> None:
        for (i, _), n in zip(pieces, self._sums([p for _, p in pieces], batch_bytes)):
            found[i] += n

    def _sums(self, lists: list[list[str]], batch_bytes: int) -> list[int]:
        """Sum of the counts of each list; every distinct string that is not remembered is encoded once, in calls by bytes."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        new = sorted(set().union(*lists) - known.keys(), key=len)
        call, filled = [], 0
        for piece in [*new, None]:
            weight = batch_bytes if piece is None else len(piece) if piece.isascii() else len(piece.encode())
            if call and filled + weight > batch_bytes:
                known.update(zip(call, self.many(call)))
                call, filled = [], 0
            if piece is not None:
                call.append(piece)
                filled += weight
        sums = [sum(map(known.__getitem__, pieces)) for pieces in lists]
        for piece in reversed(new):
            if len(piece) <= KNOWN_CHARS:
                break
            del known[piece]
        return sums


_COUNTERS: dict[int, Counter] = {}


def counter(kind: str, raw: bytes) -> Counter:
    """The counter of a vocabulary file; one for each Python worker."""
    key = xxhash.xxh3_64_intdigest(raw)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter.of(kind, raw)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", limit: int = 512,
                 batch_bytes: int = BATCH_BYTES, part_chars: int = PART_CHARS) -> DataFrame:
    """Add n_bytes (of UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of ``text``.

    ``vocabulary`` is a file's path on the driver (.json: tokenizers, .model:
    sentencepiece); its bytes travel with the tasks. Special strings inside
    texts are handled as the library does by default, none are added. One
    pass without a shuffle.
    """
    kind = vocabulary.rsplit(".", 1)[-1]
    shared = df.sparkSession.sparkContext.broadcast(file_bytes(vocabulary))

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = counter(kind, shared.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
            yield pa.array(_sliced(library, batch, sizes, batch_bytes, part_chars), pa.int64())

    return df.withColumns({
        "n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"), "n_tokens": lengths(F.col(text)),
    }).withColumn("over_limit", F.col("n_tokens") > limit)


def _sliced(library: Counter, batch: pa.Array, sizes: list[int], batch_bytes: int, part_chars: int) -> list[int]:
    """Counts of an Arrow batch, whose texts become Python strings a few calls' worth at a time."""
    found, start, held = [], 0, 0
    for i, size in enumerate([*sizes, 0]):
        if i == len(sizes) or held + size > 16 * batch_bytes and i > start:
            found += library.counts(batch[start:i].to_pylist(), sizes[start:i], batch_bytes, part_chars)
            start, held = i, 0
        held += size
    return found
