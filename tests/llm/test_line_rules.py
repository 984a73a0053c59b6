import re
from collections import Counter

from propensity.llm.line_rules import SCHEMA, clean_lines, line_rules

from .conftest import pairs


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def check(df):
    want = sorted((str(i), *plain(t)) for i, t in pairs(df))
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                  r["n_repeat_words"], r["base_failed"]) for r in line_rules(df).collect())
    assert got == want


def test_counts_equal_plain_python(small, odd, clash):
    for df in (small, odd, clash):
        check(df)


def test_empty_table(none):
    assert line_rules(none).count() == 0 and clean_lines(none).columns == none.columns
    assert [c.split()[0] for c in SCHEMA.split(", ")] == line_rules(none).columns


def test_failing_lines_go_and_the_rest_stays(spark):
    prose = "This is a sentence of quite ordinary prose that ends as it should, with a full stop and no noise."
    other = "Here another line follows, which says something else again, and it closes like the first one did."
    text = f"Home | News | Shop | Log in\n{prose}\nRead more\n{other}\nok"
    df = spark.createDataFrame([(1, text, 9), (2, "Home | News | Shop | Log in | Jobs\n" * 9, 9)],
                               "doc_id long, text string, kept long")
    rows = clean_lines(df).collect()
    assert [(r["doc_id"], r["text"], r["kept"]) for r in rows] == [(1, f"{prose}\n{other}", 9)]


def test_clean_documents_stay(small):
    labels = small.sparkSession.read.parquet("/root/testdata/sf0.001/labels.parquet")
    good = line_rules(small).join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert good.where("kept").count() == good.count() > 50
    bad = line_rules(small).join(labels.where("quality = 0"), "doc_id")
    assert bad.where("not kept").count() >= 0.6 * bad.count()


def test_stock_phrases_of_four_languages(spark):
    prose = "Eine Zeile Prosa, die so lang ist wie die anderen und mit einem Punkt zu Ende geht, wie es sich gehört."
    more = "Danach folgt noch etwas ganz anderes, das niemand vorher gesagt hat und das ebenso mit einem Punkt schließt."
    stock = ["Diese Seite verwendet Cookies, damit alles besser geht.", "Tous droits réservés, et rien de plus à dire ici.",
             "Haga clic aquí para ver el resto de esta misma historia.", "By using it you agree to our Terms of Service now.",
             "POLÍTICA DE PRIVACIDAD y otras cosas que nadie lee nunca."]
    rows = [(k, f"{prose}\n{s}\n{more}") for k, s in enumerate(stock)]
    got = {r["doc_id"]: r["text"] for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: f"{prose}\n{more}" for k, _ in rows}


def test_cleaning_odd_rows_and_clashing_names(odd, clash):
    for df in (odd, clash):
        out = clean_lines(df)
        kept = Counter(r["doc_id"] for r in line_rules(df).where("kept").collect())
        assert out.columns == df.columns and Counter(r["doc_id"] for r in out.collect()) == kept
