"""Quality rules against brute force, and their defined cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from rateforge.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, rep = len(words), len(covered)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": rep,
        "base_failed": n < 50 or 100 * rep > 50 * n,
    }


def normal(line):
    return " ".join(WORD.findall(line.lower()))


def brute_judge(rows, max_docs, min_words, min_left):
    """(id, text, source) rows -> verdicts; the rows of an id are one document for the limit."""
    docs = defaultdict(set)
    for doc, text, source in rows:
        for line in {normal(x) for x in (text or "").split("\n")} - {""}:
            docs[source, line] |= {doc} - {None}
    out = []
    for doc, text, source in rows:
        base = brute_base(text)
        above = lambda x: len(docs[source, x]) > max_docs  # noqa: E731, B023
        lines = [normal(x) for x in (text or "").split("\n")]
        gone = [x for x in lines if x and above(x)]
        left = base["n_words"] - sum(len(x.split(" ")) for x in gone)
        depleted = bool(gone) and (left < min_words or left < min_left * base["n_words"])
        out.append((str(doc), *base.values(), len(set(gone)), left, not base["base_failed"] and not depleted))
    return sorted(out)


def test_base_figures_and_verdict_against_brute_force(small_docs):
    rows = [(r.doc_id, r.text, r.source) for r in small_docs.collect()]
    limits = (1, 50, 0.5)
    got = quality.judge(small_docs, *limits).collect()
    names = [*quality.FIGURES, "lines_removed", "words_left", "kept"]
    assert sorted((str(r.doc_id), *[r[c] for c in names]) for r in got) == brute_judge(rows, *limits)


def test_frequent_lines_go_per_host(docs_of):
    own = [" ".join(f"w{d}x{i}" for i in range(60)) for d in range(12)]
    rows = [(d, f"{own[d]}\n  Read   MORE here \nlast", "a") for d in range(6)]
    rows += [(d, f"{own[d]}\nread more here", "b" if d < 8 else None) for d in range(6, 12)]
    rows += [(100, "read more here\n" * 30 + "tail " * 20, "a")]
    got = {r.doc_id: r for r in quality.judge(docs_of(rows), 3, 50, 0.5).collect()}
    assert all(got[d].lines_removed == (2 if d < 6 else 0 if d < 8 else 1) for d in range(12))
    assert all(got[d].kept for d in range(12))
    assert got[0].words_left == 60 and got[9].words_left == 60
    assert got[100].lines_removed == 1 and got[100].words_left == 20 and not got[100].kept
    text = {r.doc_id: r for r in quality.clean(docs_of(rows), 3, 50, 0.5).collect()}
    assert text[0].text == own[0] and text[0].n_chars == len(own[0])
    assert text[6].text == f"{own[6]}\nread more here"
    assert text[9].text == own[9] and 100 not in text


def test_repeated_rows_and_clashing_columns(docs_of):
    """Copies of a row are one document and get the same verdict; own columns come back."""
    line = " ".join(f"a{i}" for i in range(60))
    rows = docs_of([(1, f"{line}\nnote", "h")] * 4 + [(2, line + " b\nnote", "h"), (None, f"{line} c\nnote", "h")] + [(3, f"{line} d\nonce", "h")] * 9)
    rows = rows.withColumnsRenamed({"lang": "kept"}).selectExpr("*", "1 as n_words", "'k' as key", "2 as _lines", "3 as _row")
    judged = quality.judge(rows, 1, 50, 0.5).collect()
    got = sorted((str(r.doc_id), r.lines_removed, r.words_left) for r in judged)
    assert got == [("1", 1, 60)] * 4 + [("2", 1, 61)] + [("3", 0, 62)] * 9 + [("None", 1, 61)]
    assert all(r.lines_removed == 0 for r in quality.judge(rows, 2, 50, 0.5).collect())
    cleaned = quality.clean(rows, 1, 50, 0.5)
    assert cleaned.columns == rows.columns
    got = cleaned.collect()
    assert sorted(str(r.doc_id) for r in got) == ["1"] * 4 + ["2"] + ["3"] * 9 + ["None"]
    assert all("note" not in r.text and r.n_words == 1 and r.kept == "en" for r in got)


def test_production_limit_in_small_and_hot_hosts(docs_of):
    """A line of 11 documents goes in a host of 12 as in one of 600; one of 10 documents stays."""
    own = lambda d: " ".join(f"w{d}x{i}" for i in range(60))
    rows = [(d, own(d) + ("\nfooter" if d < 11 else "") + ("\nheader" if d < 10 else ""), "small") for d in range(12)]
    rows += [(100 + d, own(d) + ("\nfooter" if d < 11 else "") + ("\nheader" if d < 10 else ""), "hot") for d in range(600)]
    got = {r.doc_id: r for r in quality.judge(docs_of(rows)).collect()}
    assert {d for d, r in got.items() if r.lines_removed} == {*range(11), *range(100, 111)}
    assert all(r.lines_removed <= 1 and r.kept for r in got.values())


def test_ties_and_a_very_long_text(docs_of):
    """Exactly the least words or share left is enough; a long text is judged whole, to its last line."""
    words = lambda n, d: " ".join(f"v{d}x{i}" for i in range(n))
    long_text = "\n".join(f"line {i} " + words(8, i) for i in range(60_000)) + "\nfooter"
    common = "c " * 50
    rows = [(0, words(50, 0) + "\nfooter", "h"), (1, words(49, 1) + "\nfooter", "h"), (2, long_text, "h")]
    rows += [(3, words(50, 3) + "\n" + common, "h"), (4, words(51, 4) + "\n" + common + "c", "h")]
    rows += [(5, words(50, 5) + "\n" + common + "\n" + common + "c", "h")]
    got = {r.doc_id: r for r in quality.judge(docs_of(rows), 1, 50, 0.5).collect()}
    assert [got[d].lines_removed for d in range(6)] == [1, 1, 1, 1, 1, 2]
    assert [got[d].kept for d in range(4)] == [True, False, True, True]
    assert got[2].n_words == 60_000 * 10 + 1 and got[2].words_left == 600_000
    cleaned = {r.doc_id: r.text for r in quality.clean(docs_of(rows), 1, 50, 0.5).collect()}
    assert cleaned[2] == long_text.removesuffix("\nfooter")


def test_lines_go_in_the_test_tables(spark):
    """The limit acts on the tables that the SQL comparison reads."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert quality.judge(docs).where("lines_removed > 0").count() > 0


def test_empty_table(docs_of):
    rows = docs_of([(1, "a", "b")]).where("false")
    assert quality.judge(rows).count() == 0 and quality.clean(rows).count() == 0


def test_plan_has_no_python(small_docs):
    for frame in (quality.judge(small_docs), quality.clean(small_docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|MapIn", plan)
