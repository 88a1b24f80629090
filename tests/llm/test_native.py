"""License scan, quality rules and decontamination on small inputs."""

import re
from collections import Counter

import pytest

from servicelens.llm import decontaminate, license_scan, near_dedup, quality

DOCS = "doc_id long, text string, words string, label string, raw int"
LONG = "alpha beta gamma delta. " * 20_000


def docs(spark, rows):
    """Rows of (id, text) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "w", None, 1) for i, t in rows], DOCS)


EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, "one two"), (4, LONG), (5, "same text here"), (5, "same text here"), (5, "other text")]


def test_quality_edge_rows(spark):
    out = quality.quality_scan(docs(spark, EDGE)).collect()
    assert len(out) == len(EDGE) and out[0].words == "w"
    got = Counter((r.doc_id, r.quality.n_words, r.quality.n_repeat_words) for r in out)
    assert got == {(1, 0, 0): 1, (2, 0, 0): 1, (3, 0, 0): 1, (None, 2, 0): 1, (4, 80_000, 80_000): 1, (5, 3, 0): 2, (5, 2, 0): 1}
    assert all(r.quality.base_failed and not r.quality.kept for r in out)
    assert quality.quality_scan(docs(spark, [])).count() == 0


def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_against_brute_force(spark):
    base = "a b c d e f g h i j. "
    texts = [base * 3 + "x", base + "q " + base + "a b c d e f g h", "é ü\r\nß\x0b#|\nline\nline\n \n\nline x", "a b c d e f g h a b c d e f g h", "😀 😀\n<>"]
    out = quality.quality_scan(docs(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    got = [tuple(r.quality[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in out]
    assert got == [brute_quality(t) for t in texts]


def test_quality_line_rules(spark):
    body = "This is a plain sentence with quite enough words.\nAnother one follows it at once, and says more.\nNobody would call any of these lines junk.\n"
    cases = {
        "clean": (body, True, 0),
        "menu": (body + "Home | News | Sport | About | Jobs | Help | Login | Contact | Search | Archive | More | End\n", True, 1),
        "mostly menu": ("a | b | c | d | e | f | g | h | i | j | k | l | m | n | o | p\n" * 2 + "One sentence that is fine by itself.", False, 2),
        "symbols": ("of### the$$$ and%%% to*** in&&& for### by$$$ at%%% on*** as&&& it### is$$$ be%%% or*** an&&& no### so$$$ if%%% up*** us&&&", False, 1),
        "shouting": (" ".join(f"WORD{i}!!" for i in range(25)), False, 1),
        "stutter": (" ".join(f"w{i} w{i} w{i} w{i}" for i in range(12)) + ".", False, 1),
        "boilerplate": (body + "Read our Privacy Policy and accept it now.", True, 1),
    }
    out = {r.label: r.quality for r in quality.quality_scan(spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "label string, text string")).collect()}
    assert {k: (q.kept, q.lines_removed) for k, q in out.items()} == {k: v[1:] for k, v in cases.items()}
    assert out["menu"].clean_text == body


def test_kept_filter_stays_above_the_lists(spark):
    kept = quality.quality_scan(docs(spark, EDGE)).where("quality.kept")
    assert kept.count() == 0


def test_license_edge_rows(spark):
    rows = [*EDGE, (6, "MIT License, mit license"), (6, "MIT License, mit license"), (7, "gnu general public public license"), (8, "the General\nPublic  License and apache-license")]
    out = license_scan.license_scan(docs(spark, rows)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.n_words for r in by[1] + by[2] + by[3]] == [0, 0, 0] and by[4][0].n_words == 80_000
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels, r.score) for r in by[6]] == [(2, 0, 2, "mit", 1.0)] * 2
    assert by[7][0].n_base == 0 and by[7][0].first_word is None and by[7][0].base_labels == ""
    assert (by[8][0].n_base, by[8][0].first_word, by[8][0].last_word, by[8][0].base_labels) == (2, 1, 5, "apache,gpl")
    assert license_scan.license_scan(docs(spark, [])).count() == 0


def test_license_passages_survive_edits(spark):
    passage = next(p for p, label in license_scan.PASSAGES.items() if label == "mit-text")
    words = passage.split()
    edited = words[:6] + ["really"] + words[6:12] + words[13:]
    rows = [(1, passage.title()), (2, " ".join(edited)), (3, " ".join(words[:5])), (4, " ".join(reversed(words)))]
    out = {r.doc_id: r for r in license_scan.license_scan(docs(spark, rows)).collect()}
    assert out[1].labels == "mit-text" and out[1].score == 1.0
    assert out[2].labels == "mit-text" and 0.7 <= out[2].score < 1
    assert out[3].labels == out[4].labels == ""


def test_license_kelvin_sign_is_no_k(spark):
    found = license_scan.license_scan(docs(spark, [(1, "toKen ring"), (2, "TOKEN ring")]), phrases={"token ring": "t"})
    assert {r.doc_id: r.n_base for r in found.collect()} == {1: 0, 2: 1}


ITEM = "Tom Baker walks 12 km to the market every day. He sells 30 apples there and Tom Baker counts each of them twice."


def leaks(spark, rows, items=((1, ITEM),), **options):
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = decontaminate.find_leaks(docs(spark, rows), benchmark, **options)
    return sorted(((r["__id"], r["item"], r["kind"]) for r in found.collect()), key=str)


def test_leaks_verbatim_and_reparameterised(spark):
    other = ITEM.replace("12 km", "45 miles").replace("30", "7").replace("Tom Baker", "Ann Miller")
    mixed = ITEM.replace("Tom Baker counts", "Bob Carter counts")
    rows = [(1, "Before. " + ITEM + " After."), (2, other), (3, mixed), (4, ITEM[:60]), (5, LONG), (6, ITEM.replace("Baker walks", "Baker slowly walks"))]
    assert leaks(spark, rows) == [(1, 1, "verbatim"), (2, 1, "reparameterised"), (6, 1, "verbatim")]
    assert leaks(spark, rows, broadcast_chars=0) == leaks(spark, rows)


def test_leak_edges(spark):
    assert leaks(spark, EDGE) == [] and leaks(spark, [], ()) == [] and leaks(spark, EDGE, ()) == []
    assert leaks(spark, [(1, ITEM), (1, ITEM)], [(1, ITEM), (1, ITEM), (2, None), (3, "")]) == [(1, 1, "verbatim")]
    found = leaks(spark, [(None, ITEM), (2, "one two three")], [(1, ITEM), (None, "one two three")])
    assert set(found) == {(None, 1, "verbatim"), (2, None, "verbatim")}


def test_drop_leaks_keeps_rows_and_columns(spark):
    rows = [(1, ITEM), (1, "clean text of the same id"), (None, ITEM), (None, None), (2, "b"), (2, "b")]
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    frame = docs(spark, rows)
    out = decontaminate.drop_leaks(frame, benchmark)
    assert out.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == {(1, "clean text of the same id"): 1, (None, None): 1, (2, "b"): 2}


@pytest.mark.parametrize("text,canon", [("See Tom there. Tom has 3,5 kg", ["see", "<name>", "there", "tom", "has", "<number>", "<unit>"]), ("Élan vital", ["élan", "vital"])])
def test_canonical_words(spark, text, canon):
    row = spark.createDataFrame([(1, text)], "k int, __text string")
    assert decontaminate.with_windows(row, ["k"], 5).select("canon").first()[0] == canon


def test_sums_and_lists_of_numbers_are_no_templates(spark):
    numbers = " ".join(str(7 * k % 101) for k in range(40))
    items = [(1, "12 + 7 - 3 = 16"), (2, numbers), (3, "Add 12 + 7 and then take 3 - 1 from it")]
    rows = [(1, "99 * 1 / 5 = 95"), (2, "99 + 1 - 5 = 95"), (3, "x 12 + 7 - 3 = 16 y"), (4, " ".join(str(k) for k in range(300, 340)))]
    rows += [(5, "so " + numbers), (6, "Add 9 + 8 and then take 2 - 1 from it"), (7, "Add 9 * 8 and then take 2 / 1 from it")]
    assert leaks(spark, rows, items) == [(3, 1, "verbatim"), (5, 2, "verbatim"), (6, 3, "reparameterised")]


def test_short_items_in_one_pass_and_in_dropping(spark):
    items = [(1, ITEM), (2, "New York"), (3, "red green blue"), (4, "one"), (5, "a b c d")]
    rows = [(1, "We saw new york, and Red green blue!"), (2, "New York."), (3, "x " + ITEM), (4, "one"), (5, "one more"), (6, "a b c d e a b c d"), (7, "a b c")]
    want = [(1, 2, "verbatim"), (1, 3, "verbatim"), (2, 2, "verbatim"), (3, 1, "verbatim"), (4, 4, "verbatim"), (6, 5, "verbatim")]
    assert leaks(spark, rows, items) == want == leaks(spark, rows, items, broadcast_chars=0)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop_leaks(docs(spark, rows), benchmark).collect()
    assert sorted(r.doc_id for r in kept) == [1, 5, 6, 7]
    scans = decontaminate.find_leaks(docs(spark, rows), benchmark)._jdf.queryExecution().optimizedPlan().toString()
    assert scans.count("posexplode") <= 2  # the documents once, the items once


def test_clashing_column_names(spark):
    """Columns named as the operators' own are kept, or replaced where the docstring says so."""
    text = "Every word of this line is plain and ends with a mark, as twenty words or more in clean documents of this kind do."
    frame = spark.createDataFrame([(1, text, "q", "x", "h", "g")], "doc_id long, text string, quality string, `__quality` string, `__hash_here` string, gram string")
    scanned = quality.quality_scan(frame)
    assert scanned.columns.count("quality") == 1 and scanned.first()["quality"]["kept"] is True
    assert quality.drop_rejected(frame).collect() == frame.collect()
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.drop_leaks(frame, benchmark).collect() == frame.collect()
    assert near_dedup.drop_near_duplicates(frame).collect() == frame.collect()


def test_first_word_positions(spark):
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = decontaminate.find_leaks(docs(spark, [(1, "x y. " + ITEM)]), benchmark).first()
    assert (found.first_word, found.last_word, found.cover) == (2, 2 + len(ITEM.split()) - 1, 1.0)
    assert found["item"] == 1


def test_leaks_in_another_case(spark):
    rows = [(1, "x y " + ITEM.upper()), (2, "x y " + ITEM.title()), (3, ITEM.lower())]
    assert leaks(spark, rows) == [(1, 1, "verbatim"), (2, 1, "verbatim"), (3, 1, "verbatim")]
    assert leaks(spark, rows, broadcast_chars=0) == leaks(spark, rows)


def test_leaks_with_placeholders_in_a_row(spark):
    items = [
        (1, "The numbers 3 7 12 5 9 11 are written on a board and each pupil adds two of them."),
        (2, "The New York City Police Department Chief opened a small shop beside the old harbour last week."),
    ]
    other = items[0][1].replace("3 7 12 5 9 11", "8 4 6 2 1 10")
    rows = [(1, items[0][1]), (2, "Before. " + items[1][1]), (3, other), (4, items[1][1].upper())]
    wanted = [(1, 1, "verbatim"), (2, 2, "verbatim"), (3, 1, "reparameterised"), (4, 2, "verbatim")]
    assert leaks(spark, rows, items) == wanted
    assert leaks(spark, rows, items, broadcast_chars=0) == wanted


def test_leaks_partial_edited_short_and_inside_a_sentence(spark):
    words = [a + b for a in "ba ce di fo gu ha je ki".split() for b in "ran len min sto var pel tis".split()]
    edited = [" ".join([*words[:i], "other", *words[i + 1 : 23]]) for i in range(23)]
    items = [(1, " ".join(words)), (2, " ".join(words[:23])), (3, "What is the capital of France today"), (4, "largest moon of Saturn"), (5, "Saturn")]
    rows = [(100 + i, t) for i, t in enumerate(edited)]
    found = leaks(spark, rows, items[1:])
    assert found == [(100 + i, 2, "verbatim") for i in range(23)]
    rows = [(1, "zu " + " ".join(words[9:49]) + " za zo"), (2, "tell me What is the capital of France today please"), (3, "tell me What is the capital of Spain today please")]
    rows += [(4, "Titan is the Largest moon of Saturn by far, and cold."), (5, " ".join(words[30:42])), (6, "saturn"), (7, "largest moon of Jupiter is not it")]
    wanted = [(1, 1, "verbatim"), (2, 3, "verbatim"), (3, 3, "reparameterised"), (4, 4, "verbatim"), (6, 5, "verbatim")]
    assert leaks(spark, rows, [items[0], *items[2:]]) == wanted
    assert leaks(spark, rows, [items[0], *items[2:]], broadcast_chars=0) == wanted


def test_quality_keeps_clean_lines_with_parts_of_phrases(spark):
    rest = " and then many other clean words follow here one after the next until this long line is finally over, with thirty of them or so in all."
    article = "The council spoke of its privacy policy for an hour" + rest
    texts = ["We design interfaces" + rest, "They spread more" + rest, article, "Privacy Policy | x y z\nSign in\nRead more.\n" + article]
    found = quality.quality_scan(docs(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [(r.quality.lines_removed, r.quality.kept) for r in found] == [(0, True), (0, True), (0, True), (3, True)]
    assert [r.quality.words_lost for r in found] == [0, 0, 0, 10]


@pytest.mark.parametrize("label", ["mit-text", "apache-text", "gpl-text", "bsd-text"])
def test_license_passages_with_one_inserted_word(spark, label):
    words = next(p for p, name in license_scan.PASSAGES.items() if name == label).split()
    rows = [(i, " ".join([*words[:i], "really", *words[i:]])) for i in range(1, len(words))]
    found = {r.doc_id: r.labels.split(",") for r in license_scan.license_scan(docs(spark, rows)).collect()}
    assert [i for i, labels in found.items() if label not in labels] == []
