"""Document fingerprints: a Merkle tree over sections and paragraphs.

Leaves are phrases: runs of words of a paragraph (a line) that end after words
chosen by their hash, so that an edit moves no other cut. A paragraph's hash
covers its leaves, a section's its paragraphs (sections end at blank lines and
after paragraphs chosen by their hash), the root's all sections. Equal roots
mean equal texts; different roots are walked down to the branches that differ.

The fingerprint string is the root, the branches (each section's hash, with the
hashes of its paragraphs and how many leaves these have), and the 64 least
distinct leaf hashes (a bottom-k sketch of the leaves). The likeness of two
fingerprints is 1 for equal roots. Else equal branches count with all their
leaves, and the walk goes down where they differ; what paragraphs that differ
still share, the sketch tells: of the two Dice coefficients the greater holds.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_digest

from . import common

SKETCH = 64
MAX_PHRASE = 8


def _phrases(paragraph: bytes) -> list[bytes]:
    words = paragraph.split(b" ")
    out, at = [], 0
    for i, w in enumerate(words, 1):
        if crc32(w) & 3 == 0 or i - at == MAX_PHRASE:
            out.append(b" ".join(words[at:i]))
            at = i
    if at < len(words):
        out.append(b" ".join(words[at:]))
    return out


def tree(text: bytes) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, list[bytes]]]]]]:
    """(root, sections); a section is (hash, paragraphs), a paragraph (hash, leaf hashes)."""
    sections, now = [], []
    for paragraph in text.split(b"\n"):
        leaves = list(map(xxh64_digest, _phrases(paragraph)))
        h = xxh3_128_digest(b"".join(leaves))
        now.append((h, leaves))
        if not paragraph.strip() or h[0] & 7 == 0:
            sections.append((xxh3_128_digest(b"".join(x for x, _ in now)), now))
            now = []
    if now:
        sections.append((xxh3_128_digest(b"".join(x for x, _ in now)), now))
    return xxh3_128_digest(b"".join(x for x, _ in sections)), sections


Tree = tuple[bytes, list]


def write(t: Tree) -> str:
    """The fingerprint string of a tree: root:sections:sketch, in hex digits.

    A section is its hash (8 digits), then its paragraphs, each as -hash.leaves
    (8 digits, the number in hex); sections end with a comma.
    """
    root, sections = t
    leaves = {x[:4] for _, paragraphs in sections for _, ls in paragraphs for x in ls}
    branches = "".join(h[:4].hex() + "".join(f"-{p[:4].hex()}.{len(ls):x}" for p, ls in paragraphs) + "," for h, paragraphs in sections)
    return root.hex() + ":" + branches + ":" + b"".join(sorted(leaves)[:SKETCH]).hex()


def fingerprint(text: bytes) -> str:
    return write(tree(text))


def branches(fp: str) -> list[tuple[str, list[tuple[str, int]]]]:
    """(section hash, [(paragraph hash, leaves)]) of a fingerprint string."""
    out = []
    for section in fp.split(":")[1].split(",")[:-1]:
        h, *paragraphs = section.split("-")
        out.append((h, [(p, int(n, 16)) for p, n in (x.split(".") for x in paragraphs)]))
    return out


def _walk(a: list, b: list) -> tuple[int, int, int, list[int]]:
    """(leaves of equal branches, leaves of a, leaves of b, places of the paragraphs of a that b has not)."""
    sections = Counter(h for h, _ in b)
    equal, lines, at, gone, others = 0, Counter(), 0, [], []
    for h, paragraphs in a:
        if sections[h] > 0:  # alike as a whole: not entered
            sections[h] -= 1
            equal += sum(n for _, n in paragraphs)
        else:
            others += [(at + k, p, n) for k, (p, n) in enumerate(paragraphs)]
        at += len(paragraphs)
    for h, paragraphs in b:
        if sections[h] > 0:
            sections[h] -= 1
            lines.update(p for p, _ in paragraphs)
    for k, p, n in others:
        if lines[p] > 0:
            lines[p] -= 1
            equal += n
        else:
            gone.append(k)
    return equal, *(sum(n for _, ps in x for _, n in ps) for x in (a, b)), gone


def likeness(a: str, b: str) -> float:
    """0 to 1, from two fingerprints alone."""
    if a[:32] == b[:32]:
        return 1.0
    equal, n, m, _ = _walk(branches(a), branches(b))
    x, y = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (a.rpartition(":")[2], b.rpartition(":")[2]))
    least = sorted(x | y)
    if len(x) >= SKETCH or len(y) >= SKETCH:  # where a sketch is cut off, only the least of the union are known
        least = least[:SKETCH]
    both = sum(s in x and s in y for s in least)
    jaccard = both / len(least) if least else 0.0
    return max(2 * equal / (n + m) if n + m else 0.0, 2 * jaccard / (1 + jaccard))


def differing_paragraphs(a: str, b: str) -> tuple[list[int], list[int]]:
    """From two fingerprints, the places of paragraphs of each text that the other has not: branches alike are not entered."""
    if a[:32] == b[:32]:
        return [], []
    x, y = branches(a), branches(b)
    return _walk(x, y)[3], _walk(y, x)[3]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row; null counts as the empty text."""

    def run(batch):
        return {"doc_id": batch.column("doc_id"), "fingerprint": [fingerprint(t) for t in common.utf8(batch)]}

    return common.map_arrow(common.id_and_text(docs, id_col, text_col), run, "doc_id long, fingerprint string")


def _compare(text: str, fp: str, follower: str, follower_fp: str) -> list:
    half = len(text) // 2
    edited = (text[: len(text) - half] + follower[:half]).encode()
    edited_fp = fingerprint(edited)
    gone = differing_paragraphs(fp, edited_fp)[0]
    return [len(text), hashlib.sha256(edited).hexdigest(), fp, edited_fp, likeness(fp, edited_fp), likeness(fp, follower_fp), gone[0] if gone else None, len(gone)]


_KINDS = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
_NAMES = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "first_edited", "n_edited")
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, first_edited int, n_edited int"


def with_followers(docs: DataFrame) -> DataFrame:
    """Each document against its own text edited with its follower's start, and against the follower.

    first_edited and n_edited tell which of its paragraphs (lines, from 0) the
    edit has changed, as the branches that differ locate them; null and 0 if
    none.

    The follower is the next row in descending doc_id (rows with the same id in
    the order of their texts' hashes, null ids last); after the last row comes
    the first. Null texts count as empty. One range sort puts followers side by
    side; only a partition's first and last rows need another partition, and
    these two rows a partition are matched in a second, small step.
    """
    spark = docs.sparkSession
    src = common.id_and_text(docs).withColumn("th", F.xxhash64("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").desc_nulls_last(), F.col("th")]
    run_sorted = src.repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(batches):
        part = TaskContext.get().partitionId()
        held = None  # the row that waits for its follower: id, text, fingerprint
        rows: list[list] = []

        def out():
            cols = list(zip(*rows, strict=True))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), *_KINDS)
            got = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["kind", "part", "text", "doc_id", *_NAMES])
            rows.clear()
            return got

        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                fp = fingerprint(t.encode())
                if held is None:
                    rows.append([1, part, t, i, None, None, fp, *[None] * 5])  # the first row
                else:
                    rows.append([0, part, None, held[0], *_compare(held[1], held[2], t, fp)])
                held = (i, t, fp)
                if len(rows) >= 512:
                    yield out()
        if held:
            rows.append([2, part, held[1], held[0], None, None, held[2], *[None] * 5])  # the last row
            yield out()

    found = common.materialize(run_sorted.mapInArrow(run, f"kind int, part int, text string, {_SCHEMA}"), "merkle")
    parts = sorted(r["part"] for r in found.where("kind = 1").select("part").collect())  # a row per partition
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)) or [(0, 0)], "part int, follower int")
    heads = found.where("kind = 1").select(F.col("part").alias("follower"), F.col("text").alias("f_text"), F.col("fingerprint").alias("f_fp"))
    ends = found.where("kind = 2").select("part", "doc_id", "text", "fingerprint").join(F.broadcast(after), "part").join(heads, "follower")

    def compare(batch):
        rows = [_compare(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("text", "fingerprint", "f_text", "f_fp")), strict=True)]
        cols = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
        return {"doc_id": batch.column("doc_id")} | {n: pa.array(list(c), k) for n, c, k in zip(_NAMES, cols, _KINDS, strict=True)}

    last = common.map_arrow(ends.select("doc_id", "text", "fingerprint", "f_text", "f_fp"), compare, _SCHEMA)
    return found.where("kind = 0").select("doc_id", *_NAMES).unionByName(last)
