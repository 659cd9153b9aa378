import hashlib
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from lumenlink.llm import common, merkle, queries
from tests.llm.conftest import prose


def plain_tree(text):
    """The tree by its definition, in loops: [section, [(paragraph, [leaf, ...]), ...]], all as hex digits."""
    sections, now = [], []
    for line in text.encode().split(b"\n"):
        leaves, run = [], []
        for w in line.split(b" "):
            run.append(w)
            if zlib.crc32(w) % 4 == 0 or len(run) == 8:
                leaves.append(b" ".join(run))
                run = []
        if run:
            leaves.append(b" ".join(run))
        hashes = [xxhash.xxh64(x).digest() for x in leaves]
        paragraph = xxhash.xxh3_128(b"".join(hashes)).digest()
        now.append((paragraph, hashes))
        if not line.strip() or paragraph[0] % 8 == 0:
            sections.append(now)
            now = []
    return sections + [now] * bool(now)


def plain_fingerprint(text):
    sections = plain_tree(text)
    own = [xxhash.xxh3_128(b"".join(p for p, _ in s)).digest() for s in sections]
    names = sorted({h[:4].hex() for s in sections for _, hs in s for h in hs})[:64]
    middle = "".join(h.hex()[:8] + "".join(f"-{p.hex()[:8]}.{len(hs):x}" for p, hs in s) + "," for h, s in zip(own, sections, strict=True))
    return xxhash.xxh3_128(b"".join(own)).hexdigest() + ":" + middle + ":" + "".join(names)


def plain_likeness(a, b):
    """From the texts' trees: leaves under branches alike, as bags, and the sketches' share."""
    if a == b:
        return 1.0
    sides = []
    for t in (a, b):
        sides.append([("".join(p.hex()[:8] for p, _ in s) and xxhash.xxh3_128(b"".join(p for p, _ in s)).hexdigest()[:8], [(p.hex()[:8], len(hs)) for p, hs in s]) for s in plain_tree(t)])
    (x, y), equal = sides, 0
    total = sum(n for side in sides for _, ps in side for _, n in ps)
    y = list(y)
    for h, ps in list(x):
        k = next((k for k, (g, _) in enumerate(y) if g == h), None)
        if k is not None:
            y.pop(k)
            x.remove((h, ps))
            equal += sum(n for _, n in ps)
    lines = [p for _, ps in y for p, _ in ps]
    for p, n in [q for _, ps in x for q in ps]:
        if p in lines:
            lines.remove(p)
            equal += n
    u, v = ({h[:4].hex() for s in plain_tree(t) for _, hs in s for h in hs} for t in (a, b))
    cut = 64 if max(len(u), len(v)) >= 64 else 10**9
    u, v = set(sorted(u)[:64]), set(sorted(v)[:64])
    least = sorted(u | v)[:cut]
    jaccard = sum(h in u and h in v for h in least) / len(least)
    return max(2 * equal / total, 2 * jaccard / (1 + jaccard))


def slow(rows):
    """rows: (id, text, text hash); descending ids, nulls last, ties by hash."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    out = Counter()
    for k, (i, t, _) in enumerate(order):
        t, follower = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + follower[:half]
        out[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(t), plain_fingerprint(edited), plain_likeness(t, edited), plain_likeness(t, follower))] += 1
    return out


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    got = merkle.with_followers(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == slow(rows)
    assert all((r.first_edited is None) == (r.n_edited == 0) and (r.n_edited > 0 or r.near_edited > 0) for r in got)


def test_query_is_brute_force(spark, sf):
    check(common.table(spark, sf, "documents"))
    rows = queries.op7_merkle(spark, sf).collect()
    long = [r for r in rows if r.n_chars > 400]
    assert sum(r.near_edited > 0.25 for r in long) > 0.95 * len(long)
    assert sum(r.near_next < 0.15 for r in long) > 0.9 * len(long)


def test_awkward_rows(awkward, nothing):
    check(awkward)
    check(awkward.where("doc_id = 7"))
    assert merkle.with_followers(nothing).collect() == []


def test_roots_tell_equality():
    texts = [prose(1, 300), prose(1, 300) + " ", "a\nb", "a b", "a\n\nb", "", " ", "\n"]
    roots = [merkle.fingerprint(t.encode())[:32] for t in texts]
    assert len(set(roots)) == len(texts)
    assert merkle.likeness(merkle.fingerprint(b"x y"), merkle.fingerprint(b"x y")) == 1.0


def test_branches_locate_edits():
    lines = [prose(k, 20).replace("\n", " ") for k in range(60)]
    other = lines.copy()
    other[17], other[43] = "changed line", other[43] + " more"
    x, y = (merkle.fingerprint("\n".join(t).encode()) for t in (lines, other))
    assert merkle.differing_paragraphs(x, y) == ([17, 43], [17, 43]) and merkle.differing_paragraphs(x, x) == ([], [])
    assert merkle.likeness(x, y) > 0.9


def test_likeness_is_near_the_true_share():
    for share in (0.1, 0.5, 0.9):
        words = prose(5, 4000).split(" ")
        cut = int(len(words) * share)
        other = words[:cut] + prose(6, 4000 - cut).split(" ")
        near = merkle.likeness(merkle.fingerprint(" ".join(words).encode()), merkle.fingerprint(" ".join(other).encode()))
        assert abs(near - share) < 0.2
