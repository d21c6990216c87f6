"""Substring dedup by lines and by parts of lines, against plain versions."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from lodestock.llm import hot_keys, line_dedup
from lodestock.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def plain_cut(docs, unit, least):
    """Units in order of (id, place); runs of units seen before, of at least that many characters, go."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        units = [(a, b, p) for a, b, _, p in line_dedup.units_of((text or "").encode(), unit)]
        fresh, later = set(), []
        for a, b, p in units:
            later.append(bool(p) and (p in seen or p in fresh))
            fresh.add(p)
        seen |= fresh
        gone, run = set(), []
        for i in [i for i, u in enumerate(units) if u[2]] + [None]:
            if i is not None and later[i]:
                run.append(i)
                continue
            if len(b" ".join(units[j][2] for j in run).decode()) >= least:
                gone |= set(run)
            run = []
        body = (text or "").encode()
        out[doc] = (b"".join(body[a:b] for i, (a, b, _) in enumerate(units) if i not in gone).decode(), len(gone))
    return out


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    plain = plain_cut(docs, "passage", line_dedup.PASSAGE_CHARS)
    found = QUERIES["op2_substring_dedup"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in found} == plain and any(n for _, n in plain.values())
    texts = dict(docs)
    for r in found:
        at, left = 0, ""
        for a, b in r["removed"]:
            assert at <= a < b
            left, at = left + texts[r["doc_id"]][at:a], b
        assert left + texts[r["doc_id"]][at:] == r["text"]


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_whole_units(spark, unit):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), unit).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in found} == plain_cut(docs, unit, 1)


def test_passages_in_the_middle_of_lines(spark):
    """60 shared words between own words of one line: all goes but a few words at the ends; the first stays."""
    shared = words(1, 60)
    docs = [(i, f"{words(10 + i, 25)} {shared} {words(50 + i, 25)}\n{words(90 + i, 8)}") for i in range(12)]
    docs.append((99, words(200, 80)))
    rows = {r["doc_id"]: r for r in line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[0]["removed"] == [] and rows[99]["text"] == docs[-1][1]
    for i in range(1, 12):
        (start, end), text = rows[i]["removed"][0], docs[i][1]
        assert len(rows[i]["removed"]) == 1 and end - start > 0.6 * len(shared)
        assert text[start:end].strip() in shared and rows[i]["text"] == text[:start] + text[end:]


def test_short_repeats_stay_unless_asked(spark):
    docs = [(i, f"Read more\n{words(i, 20)}\nRead more\n") for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["text"] for r in line_dedup.remove_repeats(frame).collect()} == {t for _, t in docs}
    cut = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(frame, "line").collect()}
    assert cut[0] == docs[0][1][:-10] and all("Read" not in cut[i] for i in range(1, 5))
    assert {r["n_removed"] for r in line_dedup.remove_repeats(frame, "line", min_chars=10).collect()} == {0}


@settings(max_examples=200, deadline=None)
@given(st.text("ab \n\té😀", max_size=60))
def test_parts_tile_the_text(text):
    body = text.encode()
    ends = line_dedup.part_ends(body)
    assert ends == sorted(set(ends)) or body == b"" or len(ends) == 1
    assert ends[-1] == len(body)
    parts = [body[a:b] for a, b in zip([0, *ends], ends)]
    assert b"".join(parts) == body
    for part in parts:  # a line break only within the blanks at either end
        assert b"\n" not in part.strip()


@settings(max_examples=100, deadline=None)
@given(st.text("abc \n", max_size=30), st.integers(0, 50))
def test_parts_do_not_depend_on_what_stands_before(before, seed):
    shared = words(seed, 40)
    body = f"{before} {shared}".encode()
    own = [e - (len(body) - len(shared)) for e in line_dedup.part_ends(body)]
    assert [e for e in own if e > 0] == line_dedup.part_ends(shared.encode())


def test_odd_rows(spark):
    docs = [
        (1, LINE + "\n" + LINE, "a"), (2, LINE + " fifteen", "b"), (2, LINE + " fifteen", "b"), (3, None, None), (4, "", "x"), (5, "  \n\t ", "y"),
        (6, "x" * 70_000, "z"), (7, ("lorem ipsum dolor " * 30 + "\n") * 200, "w"), (8, words(4, 9000), "v"), (9, words(4, 9000).upper(), "v"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_units string").withColumnRenamed("n_units", "N_Units")
    for unit, least in (("passage", 200), ("line", 1), ("paragraph", 1)):
        found = line_dedup.remove_repeats(frame, unit).collect()
        plain = plain_cut([d[:2] for d in {d[0]: d for d in docs}.values()], unit, least)
        assert len(found) == len(docs)
        assert {(r["doc_id"], r["text"] or "", r["n_removed"]) for r in found} == {(k, *v) for k, v in plain.items()}
        assert {r["text"] for r in found if r["doc_id"] == 3} == {None}
    assert line_dedup.remove_repeats(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no unit"):
        line_dedup.remove_repeats(frame, "word")


def test_short_lines_in_any_script(spark):
    long = "日本語の長い行は空白なしで一つの語になる"
    docs = [
        (1, f"Menu\n\n{long}\nown one\n\n"), (2, f" menu \nown two\n{long}\n\n \n"), (3, "own three\nx\nX"), (4, "MENU"),
        (5, "own five\n" + long),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup.remove_repeats(frame, "line").collect()}
    assert {k: r["text"] for k, r in rows.items()} == {1: docs[0][1], 2: "own two\n\n \n", 3: "own three\nx\n", 4: "", 5: "own five\n"}
    assert [rows[k]["n_removed"] for k in (1, 2, 3, 4, 5)] == [0, 2, 1, 1, 1]
    assert [tuple(x) for x in rows[5]["removed"]] == [(9, 9 + len(long))]
    floor = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(frame, "line", min_chars=5).collect()}
    assert floor[2] == " menu \nown two\n\n \n" and floor[3] == docs[2][1] and floor[5] == "own five\n"


def test_texts_without_an_id(spark):
    """Each is a document of its own, before all with an id; equal rows are one."""
    shared = words(7, 60)
    docs = [(None, f"{shared} {words(8, 20)}"), (None, f"{shared} {words(9, 20)}"), (None, f"{shared} {words(9, 20)}"), (5, f"{words(3, 9)} {shared}")]
    rows = line_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["n_removed"] > 0 for r in rows if r["doc_id"] == 5} == {True}
    by_text = {}
    for r in rows:
        if r["doc_id"] is None:
            by_text.setdefault(r["text"], []).append(r["n_removed"])
    assert sorted(map(len, by_text.values())) == [1, 2] and sorted(n[0] > 0 for n in by_text.values()) == [False, True]


@pytest.mark.parametrize("salts", [3, 64])
def test_hot_lines(spark, monkeypatch, salts):
    """A line that all documents share, beyond the share that is dealt out."""
    monkeypatch.setattr(hot_keys, "SALTS", salts)
    docs = [(i, f"{LINE}\n{words(i, 12)}\n" + (f"{words(1000 + i // 2, 12)}\n" if i % 3 else "")) for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for hot in (1, 4096):
        monkeypatch.setattr(hot_keys, "HOT_SHARE", hot)
        found = line_dedup.remove_repeats(frame, "line").collect()
        assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in found} == plain_cut(docs, "line", 1)


def test_units_are_normalised():
    body = "A  B\tc\nÉté\n \nx".encode()
    assert [re.sub(rb"\s", b"", p) for *_, p in line_dedup.units_of(body, "line")] == [b"abc", "été".encode(), b"", b"x"]
