"""Byte-pair encoding and decoding.

A text is cut into units by the vocabulary's pattern, special tokens being cut out first. The
symbols of a unit form a doubly linked list; a priority queue holds the pairs of neighbours that the
vocabulary merges, by rank and then from left to right. The first entry is taken out, its pair
merged, and the pairs with the new neighbours go in; an entry whose pair is gone meanwhile is stale
and skipped. Decoding concatenates the vocabulary's byte strings.

Texts are encoded where they lie, without a shuffle. A worker remembers the units it has met, in two
generations of at most ``REMEMBERED`` each; units above ``REMEMBERED_CHARS`` are encoded anew each
time. Memory is thus bounded by those and by one block of texts, and a unit of n symbols takes
n log n steps.

Defined results: null and empty text have no ids, and no ids decode to the empty text. Repeated rows
get equal results. Ids outside the vocabulary decode to nothing, bytes that are no UTF-8 to U+FFFD.
Other columns pass through; one named as the result is replaced.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
REMEMBERED = 400_000
REMEMBERED_CHARS = 40
#: Characters of text whose ids are given out at once.
BLOCK_CHARS = 1 << 21

# How text is cut before merging, and the code points that are letters or numbers only
# in versions of Unicode later than the one the vocabulary's library knows.
UNITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LATER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF
A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F
2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


def _later() -> str:
    spans = [entry.split("-") for entry in LATER.split()]
    return "".join(f"{chr(int(span[0], 16))}-{chr(int(span[-1], 16))}" for span in spans)


def _plain_units() -> str:
    """``UNITS`` with the code points of ``LATER`` as neither letters nor numbers."""
    later = _later()
    text = UNITS.replace(r"[^\s\p{L}\p{N}]", rf"[^\s[\p{{L}}\p{{N}}--[{later}]]]")
    for kind in "LN":
        text = text.replace(rf" ?\p{{{kind}}}+", rf" ?[\p{{{kind}}}--[{later}]]+")
    return f"(?V1){text}"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: those that print stand for themselves, the others follow
    from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in printed]
    return {chr(b): b for b in printed} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def load(path: str = VOCABULARY) -> dict:
    """A vocabulary as plain values, which can be sent to tasks: ``bytes_of`` every id, ``first``:
    the ids of the 256 bytes, ``merges``: left * width + right to rank * width + merged, ``special``
    tokens and their ids."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    letters, ids = byte_letters(), given["model"]["vocab"]
    special = {token["content"]: token["id"] for token in given["added_tokens"]}
    width = 1 + max([*ids.values(), *special.values()])
    bytes_of = [b""] * width
    for token, k in ids.items():
        bytes_of[k] = bytes(letters[letter] for letter in token)
    for token, k in special.items():
        bytes_of[k] = token.encode()
    merges = {}
    for rank, pair in enumerate(given["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left] * width + ids[right]] = rank * width + ids[left + right]
    first = [0] * 256
    for letter, byte in letters.items():
        first[byte] = ids[letter]
    return {
        "bytes_of": bytes_of, "first": first, "merges": merges, "width": width,
        "special": special,
    }


def merged(symbols: list[int], merges: dict[int, int], width: int) -> list[int]:
    """The symbols after all merges, best rank first and leftmost first among equals."""
    size = len(symbols)
    if size < 2:
        return symbols
    find = merges.get
    # Entries are rank * size + place of the left symbol; a merged symbol's right half becomes -1.
    queue = [
        (found // width) * size + at
        for at in range(size - 1)
        if (found := find(symbols[at] * width + symbols[at + 1])) is not None
    ]
    if not queue:
        return symbols
    heapify(queue)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    while queue:
        rank, at = divmod(heappop(queue), size)
        right = after[at]
        if symbols[at] < 0 or right == size:
            continue
        found = find(symbols[at] * width + symbols[right])
        if found is None or found // width != rank:
            continue
        symbols[at], symbols[right] = found % width, -1
        following = after[at] = after[right]
        if following < size:
            before[following] = at
            found = find(symbols[at] * width + symbols[following])
            if found is not None:
                heappush(queue, (found // width) * size + at)
        previous = before[at]
        if previous >= 0:
            found = find(symbols[previous] * width + symbols[at])
            if found is not None:
                heappush(queue, (found // width) * size + previous)
    return [symbol for symbol in symbols if symbol >= 0]


class Remembered(dict):
    """What ``find`` gave for a text, as int32 bytes, in two generations."""

    def __init__(self, find):
        self.find, self.older = find, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = array("i", self.find(unit)).tobytes()
            if len(unit) > REMEMBERED_CHARS:
                return ids
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[unit] = ids
        return ids


class Coder:
    """Texts to ids and back inside a task. With ``plain``, special tokens are ordinary text."""

    def __init__(self, vocabulary: dict, plain: bool = False):
        self.vocabulary = vocabulary
        self.units = regex.compile(UNITS).findall
        self.plain_units = regex.compile(_plain_units()).findall
        self.later = re.compile(f"[{_later()}]").search
        # Of special tokens at one place the longest is meant.
        special = sorted(vocabulary["special"], key=len, reverse=True)
        cut = "|".join(map(re.escape, special))
        self.special = None if plain or not special else re.compile(f"({cut})")
        self.known = Remembered(self._unit)

    def _unit(self, unit: str) -> list[int]:
        first = self.vocabulary["first"]
        symbols = [first[byte] for byte in unit.encode("utf-8", "surrogatepass")]
        return merged(symbols, self.vocabulary["merges"], self.vocabulary["width"])

    def _ordinary(self, text: str) -> bytes:
        try:
            text.encode("latin-1")  # the quickest way to see that none of them occurs
            plain = True
        except UnicodeEncodeError:
            plain = self.later(text) is None
        units = self.units(text) if plain else self.plain_units(text)
        return b"".join(map(self.known.__getitem__, units))

    def encode(self, text: str) -> bytes:
        """The ids of a text as int32 bytes."""
        if self.special is None:
            return self._ordinary(text)
        parts = self.special.split(text)
        if len(parts) == 1:
            return self._ordinary(text)
        special = self.vocabulary["special"]
        # Every second part is a special token.
        return b"".join(
            np.int32(special[part]).tobytes() if k % 2 else self._ordinary(part)
            for k, part in enumerate(parts)
        )

    def decode(self, ids: Sequence[int]) -> str:
        bytes_of = self.vocabulary["bytes_of"]
        found = b"".join([bytes_of[k] for k in ids if 0 <= k < len(bytes_of)])
        return found.decode("utf-8", "replace")


def shared_coder(state: dict, plain: bool = False) -> Coder:
    """The coder of a broadcast vocabulary: a Python worker builds it once for all its tasks."""
    name = ("coder", plain)
    if name not in state:
        state[name] = Coder(state, plain)
    return state[name]


def text_blocks(texts: pa.Array, chars: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of at most so many characters in all, or one longer text, and the index of
    the first; null as the empty text."""
    first, block, size = 0, [], 0
    for at, value in enumerate(texts):
        text = value.as_py() or ""
        if block and size + len(text) > chars:
            yield first, block
            first, block, size = at, [], 0
        block.append(text)
        size += len(text)
    if block:
        yield first, block


def list_array(parts: list[bytes]) -> pa.Array:
    """Lists of int32 from their bytes."""
    bounds = np.append(0, np.cumsum([len(part) // 4 for part in parts], dtype=np.int64))
    flat = pa.array(np.frombuffer(b"".join(parts), np.int32))
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)


def _fresh(taken: Sequence[str], name: str) -> str:
    return next(f"{name}{k}" for k in range(1 << 30) if f"{name}{k}" not in taken)


def _passed(docs: DataFrame, keep: Sequence[str] | None, *results: str) -> list[str]:
    return [name for name in (docs.columns if keep is None else keep) if name not in results]


IDS = ArrayType(IntegerType())


def encoded(
    docs: DataFrame,
    path: str = VOCABULARY,
    plain: bool = False,
    keep: Sequence[str] | None = None,
    text: str = "text",
    decoded_as: str | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them if left out) and ``ids``, those of the column
    ``text``. ``decoded_as`` names a further column with the text that the ids decode to."""
    results = ["ids"] if decoded_as is None else ["ids", decoded_as]
    kept = _passed(docs, keep, *results)
    given = _fresh(docs.columns, "text")
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    fields = [StructField(name, kind) for name, kind in zip(results, [IDS, StringType()])]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(shared.value, plain)
        for batch in batches:
            for first, texts in text_blocks(batch.column(given)):
                parts = [coder.encode(text) for text in texts]
                found = [list_array(parts)]
                if decoded_as is not None:
                    back = [coder.decode(np.frombuffer(ids, np.int32).tolist()) for ids in parts]
                    found.append(pa.array(back, pa.string()))
                rows = batch.slice(first, len(texts))
                columns = [*[rows.column(name) for name in kept], *found]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *results])

    rows = docs.select(*kept, F.col(text).cast("string").alias(given))
    return rows.mapInArrow(task, StructType([*docs.select(*kept).schema, *fields]))


def decoded(rows: DataFrame, ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``text``, what the lists in column ``ids`` decode to; null is the empty list."""
    kept = _passed(rows, None, "text")
    given = _fresh(rows.columns, "ids")
    shared = rows.sparkSession.sparkContext.broadcast(load(path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(shared.value)
        for batch in batches:
            lists = (value.as_py() or () for value in batch.column(given))
            texts = [coder.decode([k for k in found if k is not None]) for found in lists]
            columns = [*[batch.column(name) for name in kept], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text"])

    chosen = rows.select(*kept, F.col(ids).cast("array<int>").alias(given))
    return chosen.mapInArrow(
        task, StructType([*rows.select(*kept).schema, StructField("text", StringType())])
    )
