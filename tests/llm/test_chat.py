import random
import textwrap

import duckdb

from pulsegrid.llm import chat
from pulsegrid.llm.queries import ORACLES, op2_quotation_linking
from tests.compare import differences, duck
from tests.llm.helpers import SF

TALK = "conv_id long, turn int, role string, text string"
MESSAGES = [
    (1, 0, "a", "How do I pack these boxes well?\nThey are heavy."),
    (1, 1, "b", "> how do I  PACK these boxes well?\n> They are heavy.\nUse strong tape."),
    (1, 2, "c", "An unrelated remark of some length."),
    (1, 3, "a", "On Monday b wrote:\n> > They are heavy.\n> Use strong tape.\n\nThanks for that."),
    (1, 4, "d", ">> Use strong tape.\n> Thanks for that.\nAgreed."),
    (1, 5, "e", "> never said by anyone\nHm."),
    (2, 0, "a", "> Use strong tape.\nOther talk."),
]


def test_links_and_threads(spark):
    rows = {(r.conv_id, r.turn): r for r in chat.reply_ordered(spark.createDataFrame(MESSAGES, TALK)).collect()}
    assert {k: r.reply_to for k, r in rows.items()} == {(1, 0): None, (1, 1): 0, (1, 2): None, (1, 3): 1, (1, 4): 3, (1, 5): None, (2, 0): None}
    assert {k: r.thread for k, r in rows.items()} == {(1, 0): 0, (1, 1): 0, (1, 2): 2, (1, 3): 0, (1, 4): 0, (1, 5): 5, (2, 0): 0}
    assert [rows[1, t].n_quotes for t in range(6)] == [0, 1, 0, 2, 2, 1]
    assert rows[1, 1].text == "Use strong tape."
    assert all(">" not in r.text for r in rows.values())


def test_long_answer_chain_and_first_origin(spark):
    rows = [(1, 0, "a", "message number zero with words")]
    rows += [(1, i, "a", f"> message number {'zero' if i == 1 else i - 1} with words\nmessage number {i} with words") for i in range(1, 70)]
    rows += [(1, 100, "b", "message number 5 with words"), (1, 101, "b", "> message number 5 with words\nyes")]
    got = {r.turn: r for r in chat.reply_ordered(spark.createDataFrame(rows, TALK)).collect()}
    assert all(got[i].reply_to == i - 1 and got[i].thread == 0 for i in range(1, 70))
    assert got[101].reply_to == 5 and got[100].thread == 100


def test_awkward_rows(spark):
    rows = [
        (None, 0, "a", "> x\nown"), (1, None, "a", "> x\nown"), (1, 0, None, None), (1, 1, "a", ""), (1, 2, "a", ">"), (1, 3, "a", "> \n>\n"),
        (1, 4, "a", "same"), (1, 4, "a", "same"), (1, 5, "a", "> same\nb"), (1, 5, "a", "> same\nb"), (1, 6, "a", "> q\r\nown words\r\n"),
        (1, 7, "a", "word " * 200_000), (1, 8, "a", "> " + "word " * 200_000 + "\nok"),
    ]
    frame = spark.createDataFrame(rows, TALK).selectExpr("*", "'mine' thread", "'mine' level")
    got = chat.reply_ordered(frame).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[None, 0].text == "own" and by[1, 0].text is None and by[1, 2].text == "" and by[1, 3].text == ""
    assert by[1, 5].reply_to == 4 and by[1, 6].text == "own words" and by[1, 8].reply_to == 7 and by[1, 8].text == "ok"
    assert chat.reply_ordered(frame.where("false")).count() == 0


def test_against_sql(spark):
    rows = [*MESSAGES, (3, 0, "a", "first words of a talk\n\nsecond paragraph of it\nwith two lines"), (3, 1, "b", "> second paragraph of it\n> with two lines\nyes")]
    rows += [(4, i, "a", f"> message number {i - 1} with words\nmessage number {i} with words") for i in range(1, 20)]
    frame = spark.createDataFrame(rows, TALK)
    con = duckdb.connect()
    conversations = frame.toPandas()
    con.register("conversations", conversations)
    assert differences(chat.reply_ordered(frame).toPandas(), con.sql(ORACLES["op2_quotation_linking"]).df()) is None
    assert differences(op2_quotation_linking(spark, SF).toPandas(), duck(SF).sql(ORACLES["op2_quotation_linking"]).df()) is None


def test_two_of_three_paragraphs_wrapped_anew(spark):
    paragraphs = [f"paragraph {n} has a good many words in its only line so that it can be wrapped" for n in ("one", "two", "three")]
    wrapped = lambda p: "\n".join("> " + x for x in textwrap.wrap(p, 30))
    rows = [
        (1, 0, "a", "\n\n".join(paragraphs)),
        (1, 1, "b", wrapped(paragraphs[0]) + "\n>\n" + wrapped(paragraphs[2]) + "\nSeen."),
        (1, 2, "c", "\n".join("> " + x for x in (wrapped(paragraphs[1]) + "\n>  \nSeen.").split("\n")) + "\nMe too, and gladly."),
        (1, 3, "d", wrapped(paragraphs[1]) + "\nYes."),
    ]
    got = {r.turn: (r.reply_to, r.thread, r.n_quotes) for r in chat.reply_ordered(spark.createDataFrame(rows, TALK)).collect()}
    assert got == {0: (None, 0, 0), 1: (0, 0, 1), 2: (1, 0, 2), 3: (0, 0, 1)}


def test_generated_talks_against_sql(spark):
    """Replies that quote some paragraphs of an earlier message, nested, wrapped anew and with blank quoted lines."""
    draw, rows, linked = random.Random(4), [], 0
    for talk in range(12):
        said: list[list[str]] = []
        for turn in range(25):
            own = [" ".join(draw.choices(["pack", "tape", "box", "heavy", "well", "Strong", "label", "ship"], k=draw.randrange(3, 25))) for _ in range(draw.randrange(1, 4))]
            lines: list[str] = []
            level = 1
            for _ in range(draw.randrange(3) if said else 0):
                chosen = draw.sample(draw.choice(said), k=1)
                for p in chosen:
                    lines += [">" * level + " " + x for x in textwrap.wrap(p, draw.choice([20, 40, 200]))] + draw.choice([[], [">" * level], [">" * level + " "]])
                level = draw.choice([1, 1, 2, 3])
                linked += 1
            said.append(own)
            rows.append((talk, turn, "a", "\n".join([*lines, draw.choice(["\n\n", "\n \n"]).join(own)])))
    frame = spark.createDataFrame(rows, TALK)
    con = duckdb.connect()
    conversations = frame.toPandas()
    con.register("conversations", conversations)
    ours = chat.reply_ordered(frame).toPandas()
    assert differences(ours, con.sql(ORACLES["op2_quotation_linking"]).df()) is None
    assert ours.reply_to.notna().sum() > 100 < linked
