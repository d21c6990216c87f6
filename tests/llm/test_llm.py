"""Operators against plain versions, and the stated results of odd inputs."""

import hashlib
import os
import re
from datetime import date

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestock.llm import decontaminate, jaccard_join, line_dedup, packing, pseudonyms, quality, sequences, suffix_dedup, token_counts, toxicity
from lodestock.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ODD = [
    (1, LINE + "\n" + LINE, "a"), (2, LINE + " fifteen", "b"), (2, LINE + " fifteen", "b"), (3, None, None), (4, "", "x"),
    (5, "  \n\t ", "y"), (6, "card 4785380592391139 on 1987-02-28 at 152.143.123.131", "z"), (7, "é" * 3000, "w"), (8, "lone", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeats, a long word, and a column named like a computed one."""
    return spark.createDataFrame(ODD, "doc_id long, text string, n_words string").cache()


@pytest.fixture(scope="module")
def tables(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    return docs, items


def got(spark, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, FOLDER).collect())


def test_decontamination(spark, tables):
    assert got(spark, "op1_benchmark_decontamination") == sorted(brute.decontamination(*tables))


def test_decontamination_in_parts_and_spans(spark, odd):
    items = spark.createDataFrame([(1, LINE), (2, "lone"), (None, None), (3, "")], "item_id long, text string")
    whole = decontaminate.find_contamination(odd, items)
    parts = decontaminate.find_contamination(odd, items, max_broadcast_bytes=40)
    key = ["doc_id", "n_words", "n_hit", "hit_items", "hit_runs"]
    assert sorted(map(str, whole.select(key).collect())) == sorted(map(str, parts.select(key).collect()))
    assert {r["doc_id"]: r["n_hit"] for r in whole.collect()} == {1: 28, 2: 14, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 1}
    cut = decontaminate.remove_contamination(odd, items, how="spans")
    assert {r["doc_id"]: r["text"] for r in cut.collect()}[2] == " fifteen"
    assert {r["doc_id"] for r in decontaminate.remove_contamination(odd, items).collect()} == {3, 4, 5, 6, 7}
    assert decontaminate.find_contamination(odd, items.limit(0)).filter("n_hit > 0").count() == 0


def test_spans_of_mixed_case(spark):
    items = spark.createDataFrame([(1, LINE)], "item_id long, text string")
    mixed = "One TWO three fOUR " + LINE[len("one two three four ") :]
    docs = [
        (1, f"USA says iPhone {mixed} AND Tail words"), (2, LINE.upper()), (3, f"É {LINE.upper()}. End"), (4, "ALL CLEAN"),
        (5, f"{mixed}, Then A {mixed}!"), (6, None),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_contamination(frame, items, how="spans").collect()}
    assert cut == {1: "USA says iPhone  AND Tail words", 2: "", 3: "É . End", 4: "ALL CLEAN", 5: ", Then A !", 6: None}


def test_token_counts(spark, tables):
    assert got(spark, "op3_token_counts") == sorted(brute.token_counts(tables[0]))


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "a  b", "  a   b  ", "▁a ▁", "a\n b\t c", "<s> x </s>", "日本 é z"])
def test_token_counts_of_odd_blanks(text):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.piece_counter(model).totals([text]) == [brute.token_counts([(1, text)])[0][2]]


def test_packed_pieces(spark, tables):
    rows = got(spark, "op7_best_fit_packing")
    assert [r[:5] for r in rows] == sorted(brute.pieces(tables[0]))
    bins = {}
    for r in rows:
        bins.setdefault(r[5], []).append((r[6], r[3]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(r[3] for r in rows) / 2048 * 1.02 + 1


def test_plans_hold_every_document():
    rng = np.random.default_rng(3)
    for capacity in (5, 33, 100):
        counts = dict(zip(*(x.tolist() for x in np.unique(rng.integers(1, capacity + 1, 200), return_counts=True))))
        for make in (packing.best_fit_decreasing, packing.best_two_fit):
            plan = make(dict(counts), capacity)
            held = {}
            for pattern, number in plan:
                assert sum(pattern) <= capacity
                for x in pattern:
                    held[x] = held.get(x, 0) + number
            assert held == counts


def test_matrices_round_trip(spark, tables):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    whole = {}
    for r in sequences.packed_matrices(docs, shard_tokens=20_000).collect():
        parts = sequences.unpack(r["ids"], r["cu_seqlens"])
        positions = np.frombuffer(r["position_ids"], "<u2")
        assert all(positions[a] == 0 for a in r["cu_seqlens"] if a < 2048) and len(positions) == 2048
        for doc, piece, ids in zip(r["doc_ids"], r["pieces"], parts):
            whole.setdefault(doc, {})[piece] = ids
    from lodestock.llm.encoders import byte_encoder

    for doc, text in tables[0]:
        ids = np.frombuffer(byte_encoder(None, 4).encode(text), "<u4").tolist()
        assert [x for _, p in sorted(whole[doc].items()) for x in p] == [*ids, 50256]


def test_quality(spark, tables):
    assert [r[:7] for r in got(spark, "op8_quality_rules")] == sorted(brute.quality(tables[0]))


def test_pseudonyms(spark, odd):
    out = pseudonyms.pseudonymise(odd, "key")
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[6]["n_replaced"] == 3 and rows[6]["text"] != ODD[6][1] and rows[3]["text"] is None
    digits = [int(c) for c in rows[6]["text"].split()[1]][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(out, "key", back=True).collect()}
    assert back == {r[0]: r[1] for r in ODD}


def test_suffix_dedup(spark, tables):
    assert got(spark, "op9_suffix_array_dedup") == sorted(brute.removed_bytes(tables[0]))


def test_runs_are_joined():
    rng = np.random.default_rng(4)
    docs, starts = rng.integers(0, 4, 200), rng.integers(0, 400, 200)
    ends = starts + rng.integers(1, 12, 200)
    covered = {(d, x) for d, a, b in zip(docs, starts, ends) for x in range(a, b)}
    found = list(zip(*suffix_dedup.joined_runs(docs, starts, ends)))
    assert {(d, x) for d, a, b in found for x in range(a, b)} == covered
    assert all((d, b) not in covered and (d, a - 1) not in covered for d, a, b in found)
    assert len(suffix_dedup.joined_runs(docs[:0], starts[:0], ends[:0])[0]) == 0


def test_suffix_dedup_of_hot_seeds(spark):
    rng = np.random.default_rng(5)
    passage = "".join(chr(97 + x) for x in rng.integers(0, 26, 180))
    docs = [(i, "".join(chr(97 + x) for x in rng.integers(0, 26, 50)) + passage[: 120 + i] + "é") for i in range(40)]
    docs += [(100, "a" * 400), (101, "ab" * 300), (102, None), (3, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    copies, runs = suffix_dedup.removed_runs(frame, shard_segments=20, hot_seed=5)
    found = {r["doc_id"]: r["runs"] for r in runs.collect()}
    for doc, n, removed, spans, _ in brute.removed_bytes(docs):
        flat = found.get(doc, [])
        assert (sum(flat[1::2]) - sum(flat[::2]), len(flat) // 2) == (removed, spans), doc
    assert copies.count() == 0


def test_suffix_dedup_of_null_and_shared_ids(spark):
    rng = np.random.default_rng(8)
    own = ["".join(chr(97 + x) for x in rng.integers(0, 26, n)) for n in (900, 300, 150, 700, 160)]
    docs = [
        (None, own[0] + own[1]), (None, own[2]), (None, own[1] + "é" * 20), (None, own[2]), (None, None), (7, own[3] + own[0][:250]),
        (7, own[4]), (7, own[2]), (8, own[4] + own[3][500:]), (9, own[1][:99]), (-(1 << 63), own[2]), (None, "short"),
    ]
    rank = lambda d: (d[0] is not None, d[0] or 0, hashlib.sha256((d[1] or "").encode()).hexdigest())
    ranks = {key: i for i, key in enumerate(sorted({rank(d) for d in docs}))}
    plain = brute.removed_bytes([(ranks[rank(d)], d[1]) for d in docs])
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for r in suffix_dedup.remove_repeats(frame).collect():
        spans = r["removed"]
        found.append((r["doc_id"], r["n_bytes"], sum(x["end"] - x["start"] for x in spans), len(spans), hashlib.sha256(r["kept"]).hexdigest()))
    ids = {i: key[1] if key[0] else None for key, i in ranks.items()}
    assert sorted(found, key=str) == sorted([(ids[r[0]], *r[1:]) for r in plain], key=str)


def test_jaccard_join(spark, tables):
    assert got(spark, "op10_ngram_jaccard_join") == sorted(brute.components(tables[0]))


def test_jaccard_join_of_a_chain_and_odd_rows(spark, odd):
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[i : i + 40])) for i in range(12)] + [(20 + i, " ".join(words[:40])) for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got_ids = sorted(tuple(r) for r in jaccard_join.components(frame, 4, 85).collect())
    assert got_ids == sorted(brute.components(docs))
    found = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.components(odd, 4, 85).collect()}
    assert found[3] == (0, 3) and found[4] == (0, 4) and found[5] == (0, 5) and found[8] == (1, 8)


def test_jaccard_join_of_an_id_with_two_texts(spark):
    own, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "vw")
    docs = [(1, own), (2, own), (2, other), (3, other + " end"), (4, own), (5, "lone text of four")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.components(frame, 4, 85).collect())
    assert found == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 1), (5, 5)]


def test_near_duplicates_leave_one_row_each(spark):
    """Rows without an id, repeated rows, and different texts of one id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = [
        (None, a, "p"), (None, a, "p"), (7, a + " end", "q"), (9, a, "r"), (9, b, "s"), (9, b, "s"), (None, b + " end", "t"), (None, c, "u"),
        (None, c + " end", "v"), (3, "", "w"), (3, None, "x"), (None, "", "y"), (None, "", "y"), (4, c.upper() + " more of this", "z"), (4, "own", "z"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _node string")
    left = jaccard_join.drop_near_duplicates(frame)
    assert left.columns == frame.columns
    kept = sorted((tuple(r) for r in left.collect()), key=str)
    wanted = [(7, a + " end", "q"), (9, b, "s"), (3, "", "w"), (3, None, "x"), (None, "", "y"), (None, "", "y"), (4, c.upper() + " more of this", "z"), (4, "own", "z")]
    assert kept == sorted(wanted, key=str)


def luhn(text):
    digits = [int(x) for x in text if x.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def account_rest(text):
    shut = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in shut[4:] + shut[:4])) % 97


VALUES = {
    "date": (["1987-02-28", "2004/02/29", "1999.12.31"], lambda v: date.fromisoformat(re.sub(r"\D", "-", v))),
    "day first": (["28.02.1987", "01/12/2001"], lambda v: date(*map(int, re.split(r"\D", v)[::-1]))),
    "address": (["152.143.123.131", "10.0.0.1"], lambda v: all(int(p) < 256 and str(int(p)) == p for p in v.split("."))),
    "phone": (["+1 (415) 555-2671", "+44 20 7946 0958"], lambda v: True),
    "social": (["536-22-8765"], lambda v: True),
    "local phone": (["555-123-4567", "415.555.2671"], lambda v: True),
    "short date, day first": (["3/4/2020", "7.11.1985", "29-2-2004", "31/1/1999"], lambda v: date(*map(int, re.split(r"\D", v)[::-1]))),
    "short date, month first": (["3/14/2020", "2/29/2004"], lambda v: date(*[int(re.split(r"\D", v)[i]) for i in (2, 0, 1)])),
    "account": (["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "MT84MALT011000012345MTLCAST001S"], lambda v: account_rest(v) == 1),
    "card": (["4785380592391139", "4785 3805 9239 1139", "3782-822463-10005"], luhn),
}


def test_pseudonyms_keep_the_format_and_link(spark):
    """A value has one pseudonym in all documents, of its own format, another one under another key."""
    values = [(kind, v, valid) for kind, (listed, valid) in VALUES.items() for v in listed]
    docs = [(10 * i + j, f"at {v}, {'x' * j} ({v}) end.") for i, (_, v, _) in enumerate(values) for j in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    made = pseudonyms.pseudonymise(frame, "first").collect()
    other = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(frame, "second").collect()}
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(spark.createDataFrame(made), "first", back=True).collect()}
    assert back == dict(docs)
    for i, (kind, v, valid) in enumerate(values):
        rows = [r for r in made if r["doc_id"] // 10 == i]
        found = {m for r in rows for m in re.findall(r"at (.+?), x* ?\((.+)\) end", r["text"])}
        new = {x for pair in found for x in pair}
        assert len(new) == 1 and {r["n_replaced"] for r in rows} == {2}, (v, rows)
        name = new.pop()
        digits = r"\d+" if kind == "address" else r"\d"
        assert name != v and re.sub(digits, "#", name) == re.sub(digits, "#", v)
        assert valid(name) and name not in other[10 * i]


def test_values_that_fail_their_validation_stay(spark):
    text = (
        "no day 31/2/2020 or 0/4/2020 or 3/4/1820, a version 1.2.3.2020 or 10.1.2.3, a part A-555-123-4567 or 555-123-4567-8, "
        "an account DE88370400440532013000 or GB29 NWBK 6016 1331 9268 18, a card 4785380592391138, 555-123.4567"
    )
    kept = pseudonyms.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "key").first()
    # 10.1.2.3 is an address.
    assert kept["n_replaced"] == 1 and re.sub(r" or [0-9.]+, a part", " or 10.1.2.3, a part", kept["text"]) == text


def test_short_dates_are_permuted_within_their_widths(spark):
    """All dates of one form: no two share a pseudonym, and each is a day of the same form."""
    days = [f"{d}/{m}/{y}" for y in (2003, 2004) for m in range(1, 10) for d in range(10, 32) if d <= (28 + (y == 2004) if m == 2 else 30 if m in (4, 6, 9) else 31)]
    frame = spark.createDataFrame(list(enumerate(days)), "doc_id long, text string")
    made = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(frame, "key").collect()}
    assert len(set(made.values())) == len(days) and all(re.fullmatch(r"\d\d/\d/\d{4}", v) for v in made.values())
    assert all(date(*map(int, v.split("/")[::-1])) for v in made.values())
    back = pseudonyms.pseudonymise(spark.createDataFrame(list(made.items()), "doc_id long, text string"), "key", back=True)
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == list(enumerate(days))


def test_pseudonyms_of_odd_texts(spark, hard_folder):
    docs = spark.read.parquet(f"{hard_folder}/documents.parquet").withColumn("N_Replaced", F.lit("own"))
    rows = pseudonyms.pseudonymise(docs, "key").collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in rows) == sorted((r[0], r[1] or "") for r in HARD)  # nothing to hide
    assert {r["n_replaced"] for r in rows} == {0} and "N_Replaced" not in rows[0].__fields__
    with pytest.raises(TypeError):
        pseudonyms.pseudonymise(docs)


def plain_best_fit(lengths, capacity):
    """Best-fit-decreasing by trying every bin: bins used."""
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= x
        else:
            room.append(capacity - x)
    return len(room)


@pytest.mark.parametrize("shard_tokens", [6_000, 1 << 30])
def test_matrices_use_the_rows_of_plain_best_fit(spark, tables, shard_tokens):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    shards = {}
    for r in sequences.packed_matrices(docs, shard_tokens=shard_tokens).collect():
        shards.setdefault(r["shard"], []).append(np.diff(r["cu_seqlens"]).tolist())
    for rows in shards.values():
        assert len(rows) == plain_best_fit([x for r in rows for x in r], 2048)


def test_matrices_of_texts_that_share_an_id(spark):
    """Ties go by the ids, whatever the order of the rows."""
    docs = [(1, "same id, one text " * 9), (1, "same id, another text " * 9), (None, "no id"), (None, "no id at all"), (2, ""), (2, None)]
    made = [sequences.packed_matrices(spark.createDataFrame(x, "doc_id long, text string")).collect() for x in (docs, docs[::-1])]
    assert [r.asDict() for r in made[0]] == [r.asDict() for r in made[1]] and len(made[0][0]["doc_ids"]) == 6


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(1)
    filler = ["".join(chr(97 + x) for x in rng.integers(0, 20, 6)) for _ in range(300)]
    insults = ["zwyxvu", "zwyxvuing", "yzzwvx", "yzzwvxer"]
    texts, labels = [], []
    for i in range(240):
        words = [filler[j] for j in rng.integers(0, 300, 30)]
        if i % 3 == 0:
            words[5] = insults[i // 3 % 4]
        texts.append(" ".join(words).encode())
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(texts[:160], labels[:160])
    scores = toxicity._Scorer().scores(model, texts[160:])
    assert ((scores >= 0.7) == (np.array(labels[160:]) == 1)).mean() > 0.97
    inserted = toxicity._Scorer().scores(model, [b"qqqq z.w.y.x.v.u qqqq", b"qqqq zwyqxvu qqqq", b"qqqq", None])
    assert inserted[0] >= 0.7 and inserted[1] > inserted[2] and inserted[3] < 0.5
    assert toxicity.fit(texts[:3], [0, 0, 0]) is None


INSULTS = {
    "Cyrillic": ("дурак", "книга дорога вода школа город лето письмо", "д.у.р.а.к", "дуркак"),
    "CJK": ("馬鹿野郎め", "日本語の長い文章です 今日は天気がいい 図書館に行きました", "馬鹿・野郎め", "今馬鹿野郎め日"),
    "umlauts": ("dämlack", "bücher straße grüße häuser köln über möglich", "d-ä-m-l-a-c-k", "dämmlack"),
}


@pytest.mark.parametrize("script", INSULTS)
def test_toxicity_in_other_scripts(script):
    """The same shape of document, with and without the insult, in the letters of one script."""
    insult, words, inserted, doubled = INSULTS[script]
    words = words.split()
    texts = [" ".join(words[(i + j) % len(words)] for j in range(3 + i % 3)) for i in range(120)]
    labels = [int(i % 3 == 0) for i in range(120)]
    texts = [f"{t[: len(t) // 2]} {insult} {t[len(t) // 2 :]}" if y else t for t, y in zip(texts, labels)]
    model = toxicity.fit([t.encode() for t in texts], labels)
    asked = [f"{words[0]} {x}. {words[1]}" for x in (insult, insult.upper(), inserted, doubled)] + [" ".join(words), words[0], ""]
    scores = toxicity._Scorer().scores(model, [t.encode() for t in asked])
    assert (scores[:4] >= 0.7).all() and (scores[4:] < 0.5).all(), scores


def test_toxicity_of_two_ordinary_words():
    """Both words are common in clean texts, only their meeting in one sentence is not."""
    rng = np.random.default_rng(3)
    words = ["brick", "head", "house", "garden", "winter", "little", "yellow", "river", "carpet", "window"]
    texts, labels = [], []
    for i in range(300):
        chosen = [words[j] for j in rng.integers(0, len(words), 14)]
        pairs = list(zip(chosen, chosen[1:]))
        chosen = ["garden" if ("brick", "head") == p else c for c, p in zip(chosen, [*pairs, None])]
        if i % 3 == 0:
            chosen[6:8] = ["brick", "head"]
        texts.append(" ".join(chosen).encode())
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(texts[:200], labels[:200])
    scores = toxicity._Scorer().scores(model, texts[200:])
    assert ((scores >= 0.7) == (np.array(labels[200:]) == 1)).mean() > 0.95
    apart = [b"you brick head", b"a brick. Head on", b"head brick", b"brick house", b"little head"]
    scores = toxicity._Scorer().scores(model, apart)
    assert scores[0] >= 0.7 and (scores[1:] < 0.5).all(), scores


def test_sentences_and_units():
    read = toxicity.sentences_of
    assert read("One, t-w-o.  THREE! s p a c e d x\nline".encode()) == [["one", "two"], ["three"], ["s", "p", "a", "c", "e", "d", "x"], ["line"], ["spacedx"]]
    assert read("Ärger über Écoles…".encode()) == [["arger", "uber", "ecoles"]] and read(None) == [] == read(b"12 34 !")
    assert read(b"\xff broken") == [["broken"]] and all(len(u) <= 40 for s in read(b"x" * 5000) for u in s)
    assert len(read("馬鹿野郎".encode())[0]) == 1 and len(read(("馬鹿野郎" * 5).encode())[0]) > 3


def test_scores_do_not_depend_on_blocks():
    texts = [b"zwyxvu here", b"plain words only. more", b"", b"zw yx vu", "é à ü".encode()]
    model = toxicity.fit(texts * 30, [1, 0, 0, 0, 0] * 30)
    whole = toxicity._Scorer().scores(model, texts)
    one = toxicity._Scorer()
    assert np.allclose(whole, [one.scores(model, [t])[0] for t in texts]) and len(one.scores(model, [])) == 0


def test_empty_tables(spark, odd):
    empty = odd.limit(0).drop("n_words")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.train(odd, labels)).filter("score != 0").count() == 0
    for made in (
        token_counts.count_tokens(empty), sequences.pack_best_two_fit(empty), sequences.packed_matrices(empty),
        quality.judge(empty), line_dedup.remove_repeats(empty), pseudonyms.pseudonymise(empty, "key"),
        suffix_dedup.remove_repeats(empty), jaccard_join.components(empty),
    ):
        assert made.count() == 0
    assert suffix_dedup.remove_repeats(odd).count() == len(ODD) and quality.judge(odd).filter("kept").count() == 0


def test_pipeline_keeps_what_each_stage_keeps(spark, tables):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    left = toxicity.drop_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    assert left.columns == docs.columns
    kept = [tuple(r) for r in left.select("doc_id", "text").collect()]
    heads = {d for d, _, c in brute.components(kept, 5, 80) if d == c}
    kept = [x for x in kept if x[0] in heads]
    bad = {r[0] for r in brute.decontamination(kept, [tuple(r) for r in benchmark.select("item_id", "text").collect()]) if r[5]}
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == heads - bad


HARD = [
    (1, LINE + "\n" + LINE.upper(), "a", 0.5), (2, LINE + " x", "b", None), (2, LINE + " x", "b", None), (3, None, None, 1.0),
    (4, "", "x", 2.0), (5, " \n\t\x0b", "y", 3.0), (6, "lone", "z", 4.0), (7, "LONE!", "z", 4.0), (8, "é" * 3000, "w", 5.0),
    (9, "<|endoftext|> a <|endoftext|><s>", "v", 6.0), (10, "日本 語 x y 🙂 " * 40, "u", 7.0), (11, (LINE + " ") * 700, "t", 8.0),
    (12, "\x00 nul \x1f unit\r\n" * 30, "s", 9.0), (13, "ab" * 400, "r", 0.0), (14, "ab" * 400, "r", 0.0), (15, "# * $ | < >" * 9, None, None),
]


@pytest.fixture(scope="module")
def hard_folder(spark, tmp_path_factory):
    """Nulls, blanks, repeats, long words, special strings and a long text, with extra columns."""
    folder = str(tmp_path_factory.mktemp("hard"))
    spark.createDataFrame(HARD, "doc_id long, text string, n_words string, score double").write.parquet(f"{folder}/documents.parquet")
    items = [(1, LINE), (2, "lone"), (3, LINE), (4, None), (5, ""), (6, " ".join(LINE.split()[:13])), (None, "nul unit")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1), (1, 0), (99, 1), (None, 1), (4, None)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize(
    "name, plain, width",
    [
        ("op3_token_counts", brute.token_counts, 4), ("op7_best_fit_packing", brute.pieces, 5), ("op8_quality_rules", brute.quality, 7),
        ("op9_suffix_array_dedup", brute.removed_bytes, 5), ("op10_ngram_jaccard_join", brute.components, 3),
    ],
)
def test_hard_rows(spark, hard_folder, name, plain, width):
    rows = sorted(tuple(r)[:width] for r in QUERIES[name](spark, hard_folder).collect())
    assert rows == sorted(plain([r[:2] for r in HARD]))


def test_hard_rows_against_a_benchmark(spark, hard_folder):
    items = [(1, LINE), (2, "lone"), (3, LINE), (6, " ".join(LINE.split()[:13]))]
    rows = {r["doc_id"]: tuple(r) for r in QUERIES["op1_benchmark_decontamination"](spark, hard_folder).collect()}
    plain = {r[0]: r for r in brute.decontamination([r[:2] for r in HARD], items)}
    assert {k: v for k, v in rows.items() if k != 12} == {k: v for k, v in plain.items() if k != 12}
    assert rows[12][2:4] == (60, 0) and rows[12][5]  # an item of null id contaminates and is not listed
    scores = QUERIES["op4_toxicity"](spark, hard_folder).collect()
    assert len(scores) == len(HARD) and all(r["score"] == 0.0 and r["predicted"] == 0 for r in scores)


def test_windows_that_share_a_hash_are_told_apart():
    index = decontaminate.WindowIndex([("a", b"x y z"), ("b", b"y x z w"), ("c", b"x y z")], 3)
    count, runs, items = index.find([b"q x y z y x z", b"", None, b"x z w"])
    assert list(count) == [7, 0, 0, 3] and runs == [[(1, 7)], [], [], [(0, 3)]]
    assert items == [{"a", "b", "c"}, set(), set(), {"b"}]


def test_stages_keep_columns_named_like_findings(spark, hard_folder):
    docs = spark.read.parquet(f"{hard_folder}/documents.parquet").withColumn("_gone", F.lit(1)).withColumn("N_Hit", F.lit("own"))
    docs = docs.withColumn("n_replaced", F.lit("mine"))
    own = {(r["doc_id"], r["score"], r["n_words"]) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, hard_folder)
        assert left.columns == docs.columns
        rows = left.collect()
        assert rows and {(r["doc_id"], r["score"], r["n_words"]) for r in rows} <= own
        assert {(r["_gone"], r["N_Hit"], r["n_replaced"]) for r in rows} == {(1, "own", "mine")}


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, LINE), (None, LINE), (1, LINE), (None, None)], "doc_id long, text string")
    assert len(jaccard_join.components(docs).collect()) == 4
    assert {tuple(r) for r in jaccard_join.drop_near_duplicates(docs).collect()} == {(1, LINE), (None, None)}
    assert suffix_dedup.remove_repeats(docs).count() == 4 and line_dedup.remove_repeats(docs).count() == 4
    assert sequences.pack_best_two_fit(docs).count() == 4 and toxicity.score(docs, None).count() == 4
