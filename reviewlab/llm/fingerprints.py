"""Document fingerprints: a Merkle tree over sections and paragraphs.

A paragraph is a line of the text. A paragraph whose digest is divisible by ``SECTION`` ends a section, so an edit moves section
borders near it only. Digests are SHA-256: of a paragraph's UTF-8 bytes, of a section's paragraph digests, and of the document's
section digests (the root), each level with a prefix of its own. A paragraph also lists its phrases (a phrase ends with white
space after a word that ends in a mark or one of two letters, or after ``LONGEST`` code points), so a change inside a paragraph
leaves the rest of it comparable.

The fingerprint is text: the root in hex, ``:`` and the text's length, then ``/`` and each section; a section is its paragraphs
joined by ``.``; a paragraph has four base-64 signs per phrase (18 bits of its CRC, its length in six). Equal roots mean equal texts. Unequal fingerprints
are compared from the top: equal sections match whole, then equal paragraphs of the other sections, then equal phrases of
the other paragraphs. What is left says where the texts differ (``differences``); the matched share of both texts' code
points (Dice) is their likeness, below 1 for unequal roots.

``edited_fingerprints`` pairs each document with the next one by id. Bounds are actual keys, a hash sample of about one in
``BLOCK_ROWS / 8``; the rows from one bound to the next are a block, and the row that opens a block is also sent to the block
before it. So texts are shuffled once, and each block is read in order as a stream.

Defined cases: null text is empty; an empty text has one empty paragraph; null ids come first; rows of equal id are ordered by a
hash of their text, then by the text; one single row is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from base64 import urlsafe_b64decode, urlsafe_b64encode
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, importable, texts_of

LONGEST = 60                # code points of a phrase before a cut; up to three of white space follow
SECTION = 8                 # paragraphs per section, on average
BLOCK_ROWS = 2048           # rows per block, about
MOST_BLOCKS = 1 << 16       # bounds held by the driver; beyond this the blocks grow
SAMPLED = 8                 # keys sampled per block

_PHRASES = re.compile(rf"\S.{{0,{LONGEST - 2}}}?(?:(?<=[ae.,;:!?。！？])\s{{1,3}}|$)|\S.{{0,{LONGEST - 1}}}|\s{{1,{LONGEST}}}")
SIGNS = 4                   # signs of a phrase
_LENGTH = bytes(i & 63 for i in range(256))


def _hash(prefix: bytes, data: bytes) -> bytes:
    return hashlib.sha256(prefix + data).digest()


def _prints(line: str) -> str:
    return urlsafe_b64encode(b"".join([((crc32(s.encode()) & 0x3FFFF) << 6 | len(s)).to_bytes(3) for s in _PHRASES.findall(line)])).decode()


def _weight(prints: str) -> int:
    """Code points of the phrases with these prints."""
    return sum(urlsafe_b64decode(prints)[2::3].translate(_LENGTH))


def fingerprint(text: str | None) -> str:
    """The fingerprint of one text (see the module)."""
    sections, branch, digests, tops = [], [], [], []
    for line in (text or "").split("\n"):
        digest = _hash(b"p", line.encode())
        digests.append(digest)
        branch.append(_prints(line))
        if digest[-1] % SECTION == 0:
            sections.append(".".join(branch))
            tops.append(_hash(b"s", b"".join(digests)))
            branch, digests = [], []
    if digests:
        sections.append(".".join(branch))
        tops.append(_hash(b"s", b"".join(digests)))
    return "/".join([f"{_hash(b'r', b''.join(tops)).hex()}:{len(text or '')}", *sections])


def _paired(a: list[str], b: list[str]) -> tuple[Counter, list[str], list[str]]:
    """Items that both lists hold (with multiplicity), and the rest of each in order."""
    both = Counter(a) & Counter(b)
    if not both:
        return both, a, b
    rests = []
    for items in (a, b):
        free, rest = both.copy(), []
        for x in items:
            if free[x] > 0:
                free[x] -= 1
            else:
                rest.append(x)
        rests.append(rest)
    return both, *rests


def likeness(a: str, b: str) -> float:
    """Share (0 to 1) of code points in branches that both fingerprints hold; 1 only for equal roots."""
    (top_a, *sa), (top_b, *sb) = a.split("/"), b.split("/")
    if top_a == top_b:
        return 1.0
    whole = int(top_a.split(":")[1]) + int(top_b.split(":")[1]) + 2         # code points, and a line feed per text more
    sections, sa, sb = _paired(sa, sb)
    paragraphs, la, lb = _paired([p for s in sa for p in s.split(".")], [p for s in sb for p in s.split(".")])
    for s, n in sections.items():
        for p in s.split("."):
            paragraphs[p] += n
    la, lb = [[p[i:i + SIGNS] for p in ps for i in range(0, len(p), SIGNS)] for ps in (la, lb)]
    shared = sum(n * (1 + _weight(p)) for p, n in paragraphs.items()) + _weight("".join((Counter(la) & Counter(lb)).elements()))
    return min(2 * shared / whole, 1.0 - 1.0 / (whole + 1))


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a``, from 0, whose branches ``b`` does not hold: where the texts differ."""
    (top_a, *ours), (top_b, *theirs) = a.split("/"), b.split("/")
    if top_a == top_b:
        return []
    free, out, open_ = Counter(theirs), [], []
    for n, s in enumerate(ours):
        if free[s] > 0:
            free[s] -= 1
        else:
            open_.append((n, s.split(".")))
    paragraphs = Counter(p for s, k in free.items() for _ in range(k) for p in s.split("."))
    for n, branch in open_:
        for m, p in enumerate(branch):
            if paragraphs[p] > 0:
                paragraphs[p] -= 1
            else:
                out.append((n, m))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, n_sections, n_paragraphs) of every document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t) for t in texts_of(batch.column("text")).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints, pa.string()), pa.array([p.count("/") for p in prints], pa.int64()),
             pa.array([p.count("/") + p.count(".") for p in prints], pa.int64())],
            names=["doc_id", "fingerprint", "n_sections", "n_paragraphs"])
    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, fingerprint string, n_sections long, n_paragraphs long")


def block_bounds(keyed: DataFrame, block_rows: int = BLOCK_ROWS) -> list[tuple]:
    """The first keys (known, doc_id, tie) of the blocks, in order; the smallest key of all is the first."""
    key = F.struct("known", "doc_id", "tie")
    n, low = keyed.agg(F.count(F.lit(1)), F.min(key)).first()
    if not n:
        return []
    blocks = min(max(1, n // block_rows), MOST_BLOCKS)
    some = keyed.where(F.pmod(F.xxhash64("doc_id", "tie", F.lit("bounds")), F.lit(n)) < SAMPLED * blocks)
    keys = sorted(tuple(r) for r in some.select("known", "doc_id", "tie").distinct().collect())     # about 8 per block
    return sorted({tuple(low), *keys[SAMPLED::SAMPLED]})


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (block, halo, known, doc_id, tie, text) of every document, partitioned by block and sorted; each block ends with the
    row that follows it (``halo``), the last block with the first row of all."""
    keyed = docs.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    names = ["block", "halo", *keyed.columns]
    bounds = docs.sparkSession.sparkContext.broadcast(block_bounds(keyed.drop("text"), block_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, opened = bounds.value, set()
        for batch in batches:
            keys = zip(*[batch.column(i).to_pylist() for i in range(3)])
            block, again, back = [], [], []
            for i, key in enumerate(keys):
                b = bisect.bisect_right(starts, key) - 1
                block.append(b)
                if starts[b] == key and key not in opened:
                    opened.add(key)
                    again.append(i)
                    back.append((b or len(starts)) - 1)
            for part, at, halo in ((batch, block, 0), (batch.take(pa.array(again, pa.int64())), back, 1)):
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([halo] * len(at), pa.int32()), *part.columns],
                                                     names=names)
    importable(docs.sparkSession)
    routed = keyed.mapInArrow(run, "block long, halo int, known boolean, doc_id long, tie long, text string")
    return routed.repartition("block").sortWithinPartitions("block", "halo", "known", "doc_id", "tie", "text")


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_fingerprints(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: the fingerprints of its text and of an edited text, and how near these and the next document's are.

    The edited text has the last half of the code points (rounded down) replaced by as many first ones of the next document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                     # (block, known, doc_id, text, fingerprint) of the row before
        for batch in batches:
            out = []
            for block, halo, known, doc_id, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                if held is not None and halo and held[0] != block:
                    raise ValueError(f"block {held[0]} has no following row")
                if held is None and halo:
                    continue                            # the following row of this block, sent by several tasks
                mark = fingerprint(text)
                if held is not None:
                    _, has_id, i, own, own_mark = held
                    half = len(own) // 2
                    edited = own[:len(own) - half] + text[:half]
                    new_mark = fingerprint(edited)
                    out.append((i if has_id else None, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_mark, new_mark,
                                likeness(own_mark, new_mark), likeness(own_mark, mark)))
                held = None if halo else (block, known, doc_id, text, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    names=[c.split()[0] for c in EDITED.split(", ")])
    return with_next(docs, block_rows).mapInArrow(run, EDITED)
