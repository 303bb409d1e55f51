from tidemark.llm.chat_quotes import link_quotes


def test_quotes_link_and_go(spark):
    a, b = "How do I sort a table by two keys?", "Use an order clause with both columns."
    rows = [
        (1, 0, "user", a), (1, 1, "assistant", b), (1, 2, "user", f"> {b}\n\nThat works well."), (1, 3, "user", f">> {a}\n> {b.upper()}\nStill unsure about it."),
        (1, 4, "user", "> That works well.\nGood to hear."), (1, 5, "user", "> never said by anyone here\nno link"), (2, 0, "user", f"> {a}\nother conversation"),
        (3, 0, None, None), (None, 0, "user", "> x"), (4, None, "user", "y"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "2 as root")
    got = {(r.conv_id, r.turn): r for r in link_quotes(df).collect()}
    assert {k[1]: (r.reply_to, r.root, r.depth) for k, r in got.items() if k[0] == 1} == {0: (None, 0, 0), 1: (None, 1, 0), 2: (1, 1, 1), 3: (1, 1, 1), 4: (2, 1, 2), 5: (None, 5, 0)}
    assert [t for _, t in sorted((r.position, r.turn) for k, r in got.items() if k[0] == 1)] == [0, 1, 2, 3, 4, 5]
    assert got[1, 3].text == "Still unsure about it." and got[1, 3].n_quotes == 2
    assert got[2, 0].reply_to is None and got[2, 0].text == "other conversation"
    assert got[3, 0].text == "" and got[None, 0].position is None and len(got) == len(rows)
    assert link_quotes(df.limit(0)).collect() == []


def test_deeper_levels_and_short_quotes_link(spark):
    rows = [
        (1, 0, "user", "Which port does the server use?"), (1, 1, "assistant", "是的，可以。"), (1, 2, "user", ">> Which port does the server use?\nI wonder too."),
        (1, 3, "user", "> 是的，可以。\n好"), (1, 4, "user", "ok\nbut that is all I know"), (1, 5, "user", "> ok\nnot the whole message"), (1, 6, "user", "git pull"),
        (1, 7, "user", "> Git pull\nran it"), (1, 8, "user", ">>> I wonder too.\n>> git pull\nleast level here is two"), (1, 9, "user", "> > 好\nown words of a message with a quote"),
        (1, 10, "user", "+1 👍"), (1, 11, "user", "👍"), (1, 12, "user", "> 👍\nthanks"), (1, 13, "user", "above\n--------------\nbelow"), (1, 14, "user", "> --------------\na rule is no quote"), (2, 0, "user", "> git pull\nelsewhere"),
    ]
    got = {(r.conv_id, r.turn): r for r in link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k[1]: r.reply_to for k, r in got.items() if k[0] == 1 and r.reply_to is not None} == {2: 0, 3: 1, 7: 6, 8: 6, 9: 3, 12: 11}
    assert got[2, 0].reply_to is None and len(got) == len(rows)
