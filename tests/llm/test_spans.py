import itertools
import zlib
from collections import Counter

from lumenlink.llm import common, queries, spans
from tests.llm.conftest import prose


def plain_units(text):
    """Sentences by a scan of characters; long ones cut before words that are the least of some nine."""
    out, now, i = [], b"", 0
    while i < len(text):
        c = text[i : i + 1]
        now += c
        i += 1
        end = c == b"\n"
        if c in (b".", b"!", b"?"):
            while i < len(text) and text[i : i + 1] in (b".", b"!", b"?"):
                now += text[i : i + 1]
                i += 1
            end = i == len(text) or text[i : i + 1].isspace()
        if end or i == len(text):
            while i < len(text) and text[i : i + 1].isspace():
                now += text[i : i + 1]
                i += 1
            out.append(now)
            now = b""
        elif c in (b".", b"!", b"?"):  # a mark inside a word ends a unit of its own, without blanks
            out.append(now)
            now = b""
    return [u for s in out for u in plain_pieces(s)]


def plain_pieces(sentence):
    words = sentence.lower().split()
    if len(words) <= 9:
        return [sentence]
    h = [zlib.crc32(w) * 2654435761 % 2**32 for w in words]
    cuts = {min(range(k, k + 9), key=lambda i: (h[i], i)) for k in range(len(words) - 8)} - {0}
    starts, at = [], len(sentence) - len(sentence.lstrip())
    for w in words:
        at = sentence.lower().index(w, at)
        starts.append(at)
        at += len(w)
    edges = [0, *(starts[k] for k in sorted(cuts)), len(sentence)]
    return [sentence[a:b] for a, b in itertools.pairwise(edges)]


def plain_spans(units):
    """(words of each unit of the span, end) by start, by the definition."""
    words = [tuple(u.lower().split()) for u in units]
    ends_sentence = [k + 1 == len(units) or any(x in u for x in b".!?\n") for k, u in enumerate(units)]
    starts = [k == 0 or ends_sentence[k - 1] for k in range(len(units))]
    borders = set()
    for k in range(len(units)):
        if starts[k]:
            stop = next(j + 1 for j in range(k, len(units)) if ends_sentence[j])
            borders |= set(range(k + 1, stop + 1)) if sum(map(len, words[k:stop])) > 32 else {stop}
    out = []
    for i in range(len(units)):
        enough = [j for j in range(i + 2, len(units) + 1) if sum(map(len, words[i:j])) >= 12]
        if not enough:
            break
        end = enough[0]
        if starts[i]:
            passed = [b for b in sorted(borders) if b > i]
            fits = [b for k, b in enumerate(passed) if k >= 1 and sum(map(len, words[i:b])) >= 12]
            end = fits[0] if fits else end
        out.append((tuple(words[i:end]), end))
    return out


def test_plain_units_and_spans_are_the_operators():
    for t in [prose(k, 10 + 13 * k) for k in range(25)] + [_plain(k, 9 * k + 1) for k in range(1, 12)] + ["Is it. " * 60, "a" * 300, "", "..!? x", "1.5 and 2.5 is. Then no end " * 20, "one\n\ntwo! three?? four"]:
        raw = t.encode()
        assert plain_units(raw) == spans.units(raw)
        assert [e for _, e in plain_spans(plain_units(raw))] == spans.spans(spans.units(raw))[1]


def slow(rows):
    """The same rule over all documents in one place, spans told apart by their words: rows of (id, text), in the order of (id, text hash)."""
    order = sorted({(r[0] is not None, r[0] or 0, r[2], r[1] or "") for r in rows})
    seen, kept = set(), {}
    for has, i, _, text in order:
        parts = plain_units(text.encode())
        gone, own = set(), set()
        for at, (span, end) in enumerate(plain_spans(parts)):
            if span in seen or span in own:
                gone |= set(range(at, end))
            own.add(span)
        seen |= own
        kept[(i if has else None, text)] = (b"".join(u for k, u in enumerate(parts) if k not in gone).decode(), len(gone))
    return Counter((r[0], None if r[1] is None else kept[(r[0], r[1])][0], kept[(r[0], r[1] or "")][1]) for r in rows)


def check(docs):
    from pyspark.sql import functions as F

    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    out = Counter(tuple(r) for r in spans.dedup(docs).select("row.doc_id", "row.text", "n_removed").collect())
    assert out == slow(rows)


def test_query_is_brute_force(spark, sf):
    check(common.table(spark, sf, "documents"))
    assert queries.op3_spans(spark, sf).columns == ["doc_id", "text", "n_units", "n_removed"]


def test_awkward_rows(awkward):
    check(awkward)


def test_empty_table(nothing):
    assert spans.dedup(nothing).collect() == []
    assert spans.dedup_documents(nothing).columns == nothing.columns


def test_units_are_the_text():
    for t in (prose(1, 300), "", "a", "..!? x", "no end " * 90, "\n\n a. b.\t\tc", "1.5 and 2.5. Then"):
        assert b"".join(spans.units(t.encode())) == t.encode()


def test_passages_go_and_clean_texts_stay(spark):
    passage = prose(50, 60)
    docs = [(i, prose(100 + i, 80) + " " + passage + " " + prose(200 + i, 80)) for i in range(5)] + [(i, prose(300 + i, 150)) for i in range(5, 10)]
    out = {r.doc_id: r for r in spans.dedup(spark.createDataFrame(docs, "doc_id long, text string")).select("row.*", "n_removed").collect()}
    core = " ".join(passage.split(" ")[15:45])
    assert core in out[0].text and all(core not in out[i].text for i in range(1, 5))
    assert all(out[i].text == t for i, t in docs[5:])


def test_long_sentences_are_cut_by_content(spark):
    passage = " ".join(prose(60, 200).replace(".", "").replace("!", "").split())
    docs = [(i, " ".join(prose(70 + i, 45).replace(".", "").replace("!", "").split()) + " " + passage) for i in range(2)]
    out = {r.doc_id: r.text for r in spans.dedup(spark.createDataFrame(docs, "doc_id long, text string")).select("row.*").collect()}
    assert out[0] == docs[0][1] and len(out[1]) < 0.5 * len(docs[1][1])


def _plain(seed, n):
    return " ".join(prose(seed, n).replace(".", "").replace("!", "").split())


def test_any_50_shared_words_hold_a_span():
    """A passage glued to other words on both sides, with no sentence ends or few, at any place."""
    for k in range(300):
        passage = _plain(1000 + k, 50) if k % 3 == 0 else " ".join(prose(1000 + k, 50).split())
        if k % 3 == 1:  # sentences of 12 to 32 words
            words = _plain(1000 + k, 50).split(" ")
            cut = 12 + k % 21
            passage = " ".join([*words[:cut], words[cut] + ".", *words[cut + 1 :]])
        a, b = (set(spans.spans(spans.units(f"{_plain(s + k, 5 + k % 40)} {passage} {_plain(s + k + 500, 30)}".encode()))[0]) for s in (5000, 9000))
        assert a & b, k


def test_units_inside_a_sentence_are_short():
    for k in range(20):
        assert max(len(u.split()) for u in spans.units(_plain(k, 12 + 9 * k).encode())) <= 10


def test_repeated_50_word_windows_by_brute_force(spark):
    """Every stretch of 50 words or more that an earlier document of sf0.01 has loses half of its words or more."""
    rows = sorted(common.table(spark, "/root/testdata/sf0.01", "documents").selectExpr("doc_id", "coalesce(text, '')", "xxhash64(coalesce(text, ''))").collect(), key=lambda r: (r[0], r[2]))
    seen, texts, stretches, known = set(), [], [], set()
    for _, t, _ in rows:
        words = t.lower().encode().split()
        windows = [b" ".join(words[i : i + 50]) for i in range(len(words) - 49)]
        repeated = [False] * len(words)
        for i, w in enumerate(windows):
            if w in seen:
                repeated[i : i + 50] = [True] * 50
        texts.append(repeated)
        seen.update(windows)
    for (_, t, _), repeated in zip(rows, texts, strict=True):
        parts = spans.units(t.encode())
        hashes, ends = spans.spans(parts)
        gone = [False] * len(parts)
        for i, (h, j) in enumerate(zip(hashes, ends, strict=True)):
            if h in known:
                gone[i:j] = [True] * (j - i)
        known.update(hashes)
        at, place, flags = 0, 0, []  # of each byte, whether it went
        for u, g in zip(parts, gone, strict=True):
            flags += [g] * len(u)
        raw = t.encode()
        words = []
        for w in raw.split():
            place = raw.index(w, place)
            words.append(flags[place])
            place += len(w)
        while at < len(repeated):
            if repeated[at]:
                to = at
                while to < len(repeated) and repeated[to]:
                    to += 1
                stretches.append(sum(words[at:to]) / (to - at))
                at = to
            else:
                at += 1
    whole = sum(x == 0 for x in stretches)
    lost_half = sum(x >= 0.5 for x in stretches)
    assert len(stretches) > 150 and whole == 0 and lost_half == len(stretches)
