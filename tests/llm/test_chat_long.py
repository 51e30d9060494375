"""Templates that look beyond 64 turns."""

from lumenset.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def test_long_conversations_are_rendered_whole(spark):
    class Last100(chat.TurnTemplate):
        def render(self, messages):
            return chat.TurnTemplate.render(self, messages[-100:])

    class Alternating(chat.TurnTemplate):
        def render(self, messages):
            if any(role != ("assistant" if i % 2 else "user") for i, (role, _) in enumerate(messages)):
                raise ValueError("roles must alternate from a user turn on")
            return chat.TurnTemplate.render(self, messages)

    df = spark.createDataFrame([(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(130)], TURNS)
    flagged = {r.turn_index for r in chat.format_turns(df, Last100()).filter("rewrites_history").collect()}
    assert flagged == set(range(100, 130))
    turns = chat.format_turns(df, Alternating())
    assert turns.count() == 130 and turns.filter("rewrites_history").count() == 0
    assert chat.turn_local(chat.TurnTemplate()) and not chat.turn_local(Last100())
