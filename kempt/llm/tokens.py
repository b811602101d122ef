"""Token ids of whole texts with the tokenizers library, remembered by word.

Both public BPE vocabularies split a text before they merge: a single space between two
visible characters always starts a new piece, and so does a line feed between two visible
characters. So the ids of a text are those of its space-separated chunks in a row, and a
chunk has to be encoded only once. Texts in which a space or a line feed has other
neighbours are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kempt.llm.common import id_text, n_parts, slices

#: Chunks that a worker remembers for good, and chunks met once that it remembers until there
#: are too many; most different chunks of a corpus are met once.
REMEMBER, RECENT = 1 << 19, 1 << 18

_SAFE = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.S)
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_WORD_MARK = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([^\\w\\s']+)")


def _byte_letters() -> dict[int, str]:
    """The letters for bytes of byte-level vocabularies: a visible Latin-1 character stands
    for itself, the others follow from code 256 on in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Unsafe(Exception):
    """A chunk whose borders may not be borders of pieces."""


class _Chunks(dict):
    """Chunk of text to its ids as little-endian bytes; ``lead`` is put before it."""

    def __init__(self, tokenizer, dtype: str, lead: str, bare: "_Chunks | None"):
        super().__init__()
        self.merge = tokenizer.model.tokenize
        self.lower = tokenizer.encode("A").ids == tokenizer.encode("a").ids
        # a vocabulary of word ends drops white space
        self.before = lead.translate(_LETTERS) if tokenizer.encode(" a").ids != tokenizer.encode("a").ids else ""
        self.tokenizer, self.dtype, self.lead = tokenizer, dtype, lead
        self.bare = self if bare is None else bare
        self.once: dict[str, bytes] = {}
        self.feed = self.ids("\n")

    def ids(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if (got := self.once.pop(chunk, None)) is not None:  # met again
            if len(self) >= REMEMBER:
                self.clear()
            self[chunk] = got
            return got
        if chunk.isascii() and chunk.isalpha():
            # letters are one piece, so only the merges are left to do
            got = self.pack([t.id for t in self.merge(self.before + (chunk.lower() if self.lower else chunk))])
        elif not _SAFE.fullmatch(chunk):
            raise Unsafe
        elif "\n" in chunk:
            # a line feed alone is a piece, the next line starts without a space; not
            # remembered, as line ends are rarely met twice
            first, *more = chunk.split("\n")
            return self[first] + b"".join([self.feed + self.bare[x] for x in more])
        else:
            got = self.encode(chunk)
        if len(self.once) >= RECENT:
            self.once.clear()
        self.once[chunk] = got
        return got

    def encode(self, chunk: str) -> bytes:
        if m := _WORD_MARK.fullmatch(chunk):
            return self[m[1]] + self.bare[m[2]]  # letters end a piece at marks
        if _WORD.fullmatch(chunk):
            word = (chunk.lower() if self.lower else chunk).encode().decode("latin-1").translate(_LETTERS)
            return self.pack([t.id for t in self.merge(self.before + word)])
        return self.ids(self.lead + chunk)


class Encoder:
    """Encodes texts to the bytes of their ids (unsigned, little endian, ``dtype``).

    ``plain``: strings of special tokens in a text are ordinary text, so none of their ids
    occurs. Otherwise they give those ids, as the library does by itself."""

    def __init__(self, path: str, dtype: str, plain: bool):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # texts that hold such a string go to the library whole
        self.special = [] if plain else [t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()]
        self.library = Tokenizer.from_file(path) if self.special else None
        # how all of them begin, up to the first letter: most texts do not even hold that
        self.probe = re.match(r"[^\w]*", os.path.commonprefix(self.special))[0]
        tokenizer.encode_special_tokens = True
        if tokenizer.get_vocab_size() > np.iinfo(dtype).max + 1:
            raise ValueError(f"ids of {path} do not fit into {dtype}")
        self.bare = _Chunks(tokenizer, dtype, "", None)
        self.spaced = _Chunks(tokenizer, dtype, " ", self.bare)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special and self.probe in text and any(map(text.lower().__contains__, self.special)):
            return self.bare.pack(self.library.encode(text, add_special_tokens=False).ids)
        first, *more = text.split(" ")
        try:
            return self.bare[first] + b"".join(map(self.spaced.__getitem__, more))
        except Unsafe:
            return self.bare.ids(text)


_ENCODERS: dict[tuple[str, str, bool], Encoder] = {}


def encoder(path: str, dtype: str = "<u2", plain: bool = False) -> Encoder:
    """The encoder of this Python worker; a worker serves many tasks and loads it once."""
    if (path, dtype, plain) not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path, dtype, plain] = Encoder(path, dtype, plain)
    return _ENCODERS[path, dtype, plain]


def in_order(docs: DataFrame, path: str, dtype: str = "<u2", plain: bool = False, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of all texts, range by range in ascending order of doc_id (null first; rows of
    one id by a hash of their texts, then by their ids). Texts are encoded where they are read, and
    only ids are shuffled. Borders come from the ids alone; an id so frequent that borders coincide
    at it is spread over their ranges by the hash of its texts."""
    spark = docs.sparkSession
    n = n_parts(spark)
    least = F.lit(np.iinfo(np.int64).min)
    rows = id_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    shares = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx(F.coalesce("doc_id", least), shares, max(10_000, 10 * n))).first()[0] if shares else None
    borders = np.array(found or [], np.int64)

    def run(batches):
        encode = encoder(path, dtype, plain)
        for b in slices(batches):
            doc_id = b["doc_id"].fill_null(np.iinfo(np.int64).min).to_numpy()
            low, high = np.searchsorted(borders, doc_id, "left"), np.searchsorted(borders, doc_id, "right")
            share = b["h"].to_numpy() / 2.0**64 + 0.5
            at = np.minimum(low + (share * (high - low + 1)).astype(np.int64), high).astype(np.int32)
            ids = pa.array([encode(t) for t in b["text"].to_pylist()], pa.binary())
            yield pa.record_batch([pa.array(at), b["doc_id"], b["h"], ids], names=["range", "doc_id", "h", "ids"])

    coded = rows.mapInArrow(run, "range int, doc_id long, h long, ids binary")
    return coded.repartitionById(n, "range").sortWithinPartitions("doc_id", "h", "ids").select("doc_id", "ids")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
