from __future__ import annotations

from runlens.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, rows, schema=SCHEMA):
    return quotes.link_quotes(spark.createDataFrame(rows, schema)).collect()


def test_nested_and_partial_quotes(spark):
    rows = [
        (1, 0, "a", "First line.\nSecond line."),
        (1, 1, "b", "> First line.\n> Second line.\nMy answer.\n\nAnother paragraph."),
        (1, 2, "c", ">> First  line.\n>> second line.\n> My answer.\nNo.\n> Another paragraph.\nYes."),
        (1, 3, "d", "> nobody wrote this\nHm."),
        (1, 4, "e", "> > Second line.\n> Hm.\nok"),
        (2, 0, "a", "> First line.\nelsewhere"),
        (3, 0, "a", None),
        (3, 1, "a", ""),
        (None, 1, "a", "> x"),
        (3, None, "a", "> y\nz"),
    ]
    got = {(r.conv_id, r.turn): r for r in linked(spark, rows)}
    assert [got[1, t].reply_to for t in range(5)] == [None, 0, 1, None, 3]
    assert [got[1, t].thread for t in range(5)] == [0, 0, 0, 3, 3]
    assert [got[1, t].n_quotes for t in range(5)] == [0, 1, 3, 1, 2]
    assert [got[1, t].n_linked for t in range(5)] == [0, 1, 3, 0, 2]
    assert got[1, 1].own_text == "My answer.\n\nAnother paragraph."
    assert got[1, 2].own_text == "No.\nYes."
    assert got[2, 0].reply_to is None and got[2, 0].own_text == "elsewhere"
    assert got[3, 0].own_text == got[3, 1].own_text == ""
    assert len(got) == len(rows)


def test_repeated_rows_common_lines_and_extra_columns(spark):
    rows = [(1, t, "u", "Yes.", 5) for t in range(40)] + [(1, 40, "u", "> Yes.\nfine", 5)] * 3
    got = linked(spark, rows, SCHEMA + ", thread int")
    assert len(got) == 43 and {r.reply_to for r in got if r.turn == 40} == {0}
    assert linked(spark, []) == []


def test_given_conversations_come_back_whole(spark):
    table = quotes.table(spark, "/root/testdata/sf0.001", "conversations")
    mail = quotes.as_mail(table)
    assert mail.filter("text LIKE '>%'").count() > 0
    got = {(r.conv_id, r.turn): r.own_text for r in quotes.link_quotes(mail).collect()}
    assert got == {(r.conv_id, r.turn): r.text for r in table.collect()}
    order = [(r.conv_id, r.thread, r.turn) for r in quotes.reply_ordered(quotes.link_quotes(mail)).collect()]
    assert order == sorted(order)
