"""Quotations of parts of a message."""

from inkwell.llm import quote_link


def test_parts_of_paragraphs_are_linked(spark):
    first = "We meet at noon. Bring the blue folder\nand two pens! Nothing else is needed.\n\nThe room is on floor three\n\nSee you"
    rows = [(1, 0, first),
            (1, 1, "> bring the BLUE folder and\n> two pens!\n\nWhy two?"),        # a sentence, lines broken elsewhere
            (1, 2, "> and two pens! Nothing else is needed.\n> The room is on floor three\nFine"),  # two paragraphs, no blank between
            (1, 3, "> See you\n\nBye"),                                             # a whole paragraph, however short
            (1, 4, "> two?\n\nhm"),                                                 # too short a part to tell
            (1, 5, "> never said by anyone here\n\n> > why two?\n\nno"),
            (1, 6, "Nothing else is needed."),
            (1, 7, "> quite so. Nothing else is needed.\n\nok"),                    # the latest turn that says it
            (2, 1, "> Nothing else is needed.\n\nanother conversation")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv, r.turn): r for r in quote_link.link_quotes(df).collect()}
    assert {k[1]: r.reply_to for k, r in got.items() if k[0] == 1} == {0: None, 1: 0, 2: 0, 3: 0, 4: None, 5: None, 6: None, 7: 6}
    assert (got[1, 5].n_quotes, got[1, 5].n_linked) == (2, 1) and got[2, 1].reply_to is None
    assert (got[1, 1].thread, got[1, 1].depth, got[1, 1].text) == (0, 1, "Why two?")


def test_a_very_long_message_and_its_parts(spark):
    lines = [f"line number {i} of this message" for i in range(6000)]
    rows = [(1, 0, "\n".join(lines)), (1, 1, f"> {lines[4321]}\n\nthis one"), (1, 2, None), (1, 3, "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {r.turn: r.reply_to for r in quote_link.link_quotes(df).collect()}
    assert got == {0: None, 1: 0, 2: None, 3: None}


def test_chains_and_passages_across_spans(spark, monkeypatch):
    monkeypatch.setattr(quote_link, "SPAN", 4)
    rows = [(c, t, (f"> message {t - 1} of {c} here\n\n" if t else "") + f"message {t} of {c} here") for c in (1, 2) for t in range(30)]
    rows += [(3, 0, "said once at the start"), (3, 21, "> said once at the start\n\nlate"), (3, 22, "> late\n\nlater still")]
    rows += [(4, 1, "twice the same"), (4, 1, "another of this turn"), (4, 9, "> another of this turn\n\nyes"), (4, 9, "> another of this turn\n\nyes")]
    got = {(r.conv, r.turn): r for r in quote_link.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, text string")).collect()}
    assert all((got[c, t].thread, got[c, t].depth, got[c, t].reply_to) == (0, t, t - 1 if t else None) for c in (1, 2) for t in range(30))
    assert (got[3, 21].thread, got[3, 21].depth, got[3, 22].thread, got[3, 22].depth) == (0, 1, 0, 2)
    assert (got[4, 9].reply_to, got[4, 9].thread, got[4, 9].n_quotes, got[4, 9].n_linked) == (1, 1, 1, 1)


def test_a_conversation_named_like_null_keeps_its_rows_apart(spark):
    rows = [("-", 0, "first thing said"), ("-", 1, "> first thing said\n\nyes"), (None, 1, "> first thing said\n\nyes"), ("1:-", 1, "x")]
    got = {(r.conv, r.turn): (r.reply_to, r.n_quotes) for r in
           quote_link.link_quotes(spark.createDataFrame(rows, "conv_id string, turn long, text string")).collect()}
    assert got == {("-", 0): (None, 0), ("-", 1): (0, 1), (None, 1): (None, 0), ("1:-", 1): (None, 0)}
