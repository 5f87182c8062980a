"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 16 bytes cuts each text where its content says so, so
that copies, shared passages and repeated lines give the same chunks whatever
stands before them.  A chunk that is still in the worker's cache is not
encoded again.  Cuts fall anywhere, so a chunk keeps its first and last
pieces (runs without ASCII white space) apart from its body.  The joins are
repaired: the run of text across a join, from white space to white space and
over as many chunks as it takes, is encoded anew.

That gives the library's ids exactly: tokens of this vocabulary never contain
white space, so its normaliser, its splitting and its added tokens never look
across an ASCII blank, and the ids of a text are those of its pieces in turn.
For the same reasons letters A-Z are as good as a-z, and a piece that ends in
marks after a letter is a stem and its marks, so pieces that differ in these
are encoded once, and many new pieces go to the library as one text.  All this holds for tokenizers of one make; ``checked``
raises ValueError for any other.

There is no shuffle.  Reuse is within a Python worker; its caches are bounded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table, utf8

#: A chunk ends where the rolling hash has so many zero bits: 512 bytes on average.
CUT_BITS = 9
#: A chunk is cut at so many bytes where its content gives no cut.
LONGEST_CHUNK = 1 << 14
#: Bounds of a worker's caches: pieces in each of two generations (and those of the last group), bytes of
#: chunks likewise (a chunk's ids and decoded text take about four times its bytes).
CACHED_PIECES = 320_000
CACHED_CHUNK_BYTES = 4 << 20
#: Bytes of text whose pieces are looked up together.
GROUP_BYTES = 1 << 20
LONGEST_CACHED_PIECE = 64

_GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 256, np.uint32)
_STEP = 0x9E3779B1


def cuts(data: bytes) -> list[int]:
    """Where chunks of UTF-8 ``data`` end: the hash of the 16 bytes before decides.

    Cuts stand before the first byte of a character.  The work is done in
    segments, with 15 bytes of overlap, so memory does not grow with the text.
    """
    buf = np.frombuffer(data, np.uint8)
    found, segment = [], 1 << 20
    with np.errstate(over="ignore"):
        for at in range(0, len(buf), segment):
            lead = min(at, 15)
            h = _GEAR[buf[at - lead:at + segment]]
            step = np.uint32(_STEP)
            for width in (1, 2, 4, 8):  # windows of 2, 4, 8 and 16 bytes
                h[width:] = h[width:] + step * h[:-width] if len(h) > width else h[width:]
                step = step * step
            found.append(np.flatnonzero(h[lead:] >> np.uint32(32 - CUT_BITS) == 0) + at + 1)
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    out, last = [], 0
    for end in [*ends.tolist(), len(buf)]:
        while end - last > LONGEST_CHUNK:
            forced = last + LONGEST_CHUNK
            while forced > last + 1 and 0x80 <= data[forced] < 0xC0:
                forced -= 1
            out.append(forced)
            last = forced
        while end < len(buf) and 0x80 <= data[end] < 0xC0:
            end += 1
        if end > last:
            out.append(end)
            last = end
    return out


class _Generations:
    """A mapping of bounded weight: when the young half is full it becomes the old one."""

    def __init__(self, bound: int):
        self.bound, self.weight, self.young, self.old = bound, 0, {}, {}

    def get(self, key, weight: int = 1):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value, weight)
        return value

    def put(self, key, value, weight: int = 1) -> None:
        if self.weight >= self.bound:
            self.old, self.young, self.weight = self.young, {}, 0
        self.young[key] = value
        self.weight += weight

    def turned(self) -> tuple[dict, dict]:
        """The young half, to be filled by its number of keys, and the old one."""
        if len(self.young) >= self.bound:
            self.old, self.young = self.young, {}
        return self.young, self.old


#: How the tokenizer splits a normalised text (fixed value), and the parts of its normaliser.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALISERS = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"})
#: Marks that the split always parts from a letter before them.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word that parts pieces encoded in one text; a piece that holds it is encoded alone.
_MARK = b"0"
#: Pieces encoded in one text.
JOINED = 250
#: What every added token begins with; pieces that hold it are left as they are.
_ADDED = b"<|"


def checked(spec: str) -> str:
    """``spec``, if what pieces and stems rely on holds for this tokenizer."""
    d = json.loads(spec)
    split = (d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    added = [t for t in d.get("added_tokens", ()) if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
             or not t["content"].encode().startswith(_ADDED) or re.search(r"\s", t["content"])]
    model = d["model"]
    if ((d.get("normalizer") or {}).get("normalizers") != list(_NORMALISERS) or added or d.get("decoder") or d.get("post_processor")
            or split[0].get("pattern") != {"Regex": _SPLIT} or not split[0].get("invert") or split[0].get("behavior") != "Removed"
            or [x["type"] for x in split[1:]] != ["ByteLevel"] or split[1]["add_prefix_space"] or split[1]["use_regex"]
            or model["type"] != "BPE" or model.get("dropout") or any(re.search(r"\s", t) for t in model["vocab"])):
        raise ValueError("encoding by chunks is not known to hold for this tokenizer")
    return spec


#: Bytes that begin neither U+0080 to U+00BF nor a character above U+00FF.
_PLAIN = bytes([*range(0xC2), 0xC3])


def _lowered(some: bytes) -> bytes:
    """``some`` with A-Z in lower case, where ids cannot tell: no marks that could join a letter of one case alone."""
    return some if some.translate(None, _PLAIN) or _ADDED in some else some.lower()


class Encoder:
    """Encodes and decodes whole texts as the tokenizer of ``spec`` (its JSON) does."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(checked(spec))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = _Generations(CACHED_PIECES)
        self.mark_id, = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids
        self.mark_said = b" " + self.tokenizer.decode([self.mark_id]).encode() + b" "
        self.chunks = _Generations(CACHED_CHUNK_BYTES)

    def _encoded(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text with a blank behind).

        Pieces without the mark are encoded in one text, with the mark as a
        word between them: its id then stands for nothing else.
        """
        joined = [p for p in pieces if _MARK not in p and _ADDED not in p]
        made = {}
        for at in range(0, len(joined), JOINED):
            some = joined[at:at + JOINED]
            ids = self.tokenizer.encode_batch_fast([(b" " + _MARK + b" ").join(some).decode()], add_special_tokens=False)[0].ids
            said = self.tokenizer.decode(ids, skip_special_tokens=False).encode().split(self.mark_said)
            ids = np.array(ids, "<u4")
            ends, ids = (np.flatnonzero(ids == self.mark_id) * 4).tolist(), ids.tobytes()
            if len(said) == len(some) == len(ends) + 1:  # else a piece has no ids
                made.update((p, (ids[i:j], t + b" ")) for p, i, j, t in
                            zip(some, [0, *[e + 4 for e in ends]], [*ends, len(ids)], said))
        rest = [p for p in pieces if p not in made]
        for at in range(0, len(rest), 1000):
            some = rest[at:at + 1000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)]
            said = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            made.update((p, (array("I", i).tobytes(), s.encode() + b" " if i else b"")) for p, i, s in zip(some, ids, said))
        return [made[p] for p in pieces]

    def _learn(self, wanted: set[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """The young cache, with ids and decoded text of each piece: from the old one, from stem and marks, or encoded.

        It turns between groups only, and ``passing`` are the long ones to go after this group.
        """
        known, old = self.pieces.turned()
        stems, fresh = [], {}
        for p in wanted.difference(known):
            if (v := old.get(p)) is not None:
                known[p] = v
                continue
            stem = p.rstrip(_MARKS)
            if len(stem) < len(p) and stem[-1:].isalpha() and _ADDED not in p:
                stems.append((p, stem, p[len(stem):]))
            else:
                fresh[p] = None
        for _, *two in stems:
            for x in two:
                if x not in known and x not in fresh:
                    if (v := old.get(x)) is None:
                        fresh[x] = None
                    else:
                        known[x] = v
        made = list(fresh)
        known.update(zip(made, self._encoded(made)))
        for p, stem, marks in stems:
            (a, b), (c, d) = known[stem], known[marks]
            known[p] = (a + c, b + d)
            made.append(p)
        self.passing = [p for p in made if len(p) > LONGEST_CACHED_PIECE]
        return known

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded text) of each text."""
        plans, fresh, wanted = [], {}, set()
        get = self.chunks.get
        for data in texts:
            # a plan is the text's parts in turn: a piece to encode, or a chunk's body
            plan, carry, last = [], b"", 0
            for end in cuts(data):
                chunk, last = data[last:end], end
                entry = get(chunk, len(chunk)) or fresh.get(chunk)
                if entry is None:
                    pieces = chunk.split()
                    head = pieces[0] if pieces and not chunk[:1].isspace() else b""
                    blank = head != chunk
                    tail = pieces[-1] if blank and len(pieces) > bool(head) and not chunk[-1:].isspace() else b""
                    # a head or tail is lowered when its piece is whole
                    body = _lowered(chunk)
                    pieces = body.split() if body is not chunk else list(map(_lowered, pieces))
                    pieces = pieces[bool(head):len(pieces) - bool(tail)]
                    entry = fresh[chunk] = [blank, head, pieces, tail]
                    wanted.update(pieces)
                blank, head, _, tail = entry
                carry += head
                if blank:
                    if carry:
                        plan.append(_lowered(carry))
                    plan.append(entry)
                    carry = tail
            if carry:
                plan.append(_lowered(carry))
            plans.append(plan)
            wanted.update([p for p in plan if type(p) is bytes])
        known = self._learn(wanted)
        for chunk, entry in fresh.items():
            entry[2] = tuple(map(b"".join, zip(*map(known.__getitem__, entry[2])))) or (b"", b"")
            self.chunks.put(chunk, entry, len(chunk))
        out = []
        for plan in plans:
            parts = [known[p] if type(p) is bytes else p[2] for p in plan]
            out.append((b"".join([i for i, _ in parts]), b"".join([s for _, s in parts])[:-1]))
        for p in self.passing:
            del known[p]
        return out


_ENCODERS: dict[str, Encoder] = {}  # a worker that runs several tasks keeps its caches


def _encoder(spec: str) -> Encoder:
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def encoded(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs`` with n_tokens, ids (little-endian unsigned 32-bit integers) and decoded.

    A null text is an empty one: no ids, decoded to the empty text.  Repeated
    rows give repeated results.  Columns of ``docs`` with these names are
    replaced.  The file is read on the driver and sent to the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        encoder = _encoder(spec.value)

        def f(texts):
            made, group, size = [], [], 0
            for t in utf8(texts):
                group.append(t or b"")
                size += len(group[-1])
                if size >= GROUP_BYTES:
                    made += encoder.encode(group)
                    group, size = [], 0
            made += encoder.encode(group)
            return [[len(i) // 4 for i, _ in made], [i for i, _ in made], [s.decode() for _, s in made]]
        return f

    return append_columns(docs, ["text"], [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType())], start)


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op5_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return digests(encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), word_bpe_path()))
