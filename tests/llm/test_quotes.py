from __future__ import annotations

from digestry.llm.quotes import chat_messages, link_quotes

TALK = [
    (1, 0, "user", "Where does the river start? I would like to walk there."),
    (1, 1, "assistant", "It starts above the mill. The path is steep in winter."),
    (1, 2, "user", "Is there another way to the bridge?"),
    (1, 3, "user", "On Monday the guide wrote:\n> > Where does the river\n> > start?\n> It starts above the mill.\nThank you, above the mill then."),
    (1, 4, "assistant", "> is there ANOTHER way,\n> to the bridge\nYes, along the wall."),
    (1, 5, "user", ">Thank you, above the mill then.\nYou are welcome.\n> Nobody ever said this sentence.\nBye."),
    (2, 0, "user", "> It starts above the mill.\nquoted from another conversation"),
    (2, 1, None, None),
    (2, 2, "user", ""),
    (2, 2, "user", "> > >"),
    (None, 0, "user", "no conversation"),
    (None, None, "user", "> no conversation\nnot even a turn"),
]
SCHEMA = "conv_id long, turn long, role string, text string, row long, lines string, path string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", "p") for r in rows], SCHEMA).select("conv_id", "turn", "role", "text", "row", "lines", "path")


def by_key(frame):
    return {(r["conv_id"], r["turn"]): r for r in frame.collect()}


def test_quotes_are_linked_and_removed(spark):
    got = by_key(chat_messages(messages(spark, TALK)))
    assert got[1, 3]["parent_turn"] == 1 and got[1, 3]["n_quotes"] == got[1, 3]["n_linked"] == 2
    assert got[1, 3]["text"] == "Thank you, above the mill then."
    assert got[1, 4]["parent_turn"] == 2 and got[1, 4]["text"] == "Yes, along the wall."
    assert got[1, 5]["parent_turn"] == 3 and (got[1, 5]["n_quotes"], got[1, 5]["n_linked"]) == (2, 1)
    assert got[1, 5]["text"] == "You are welcome.\nBye." and got[1, 5]["depth"] == 2
    assert got[2, 0]["parent_turn"] is None and got[2, 0]["n_linked"] == 0
    assert got[2, 1]["text"] == "" and got[2, 1]["formatted"] == "<|user|>\n\n<|end|>\n"


def test_reply_order_is_depth_first(spark):
    got = [r for r in chat_messages(messages(spark, TALK)).collect() if r["conv_id"] == 1]
    assert [r["turn"] for r in sorted(got, key=lambda r: r["seq"])] == [0, 1, 3, 5, 2, 4]


def test_every_message_comes_out_once(spark):
    got = chat_messages(messages(spark, TALK)).collect()
    assert len(got) == len(TALK)
    for conv in (1, 2, None):
        assert sorted(r["seq"] for r in got if r["conv_id"] == conv) == list(range(sum(t[0] == conv for t in TALK)))
    assert chat_messages(messages(spark, [])).count() == 0


def test_levels_link_to_different_messages(spark):
    _, links = link_quotes(messages(spark, TALK[:4]))
    assert sorted((r["level"], r["source_turn"]) for r in links.collect()) == [(1, 1), (2, 0)]


def test_long_chains(spark):
    rows = [(1, 0, "user", "message number 0 of the chain.")]
    rows += [(1, t, "user", f"> message number {t - 1} of the chain.\nmessage number {t} of the chain.") for t in range(1, 40)]
    got = by_key(chat_messages(messages(spark, rows)))
    assert all(got[1, t]["depth"] == t and got[1, t]["seq"] == t for t in range(40))
