import pytest

from opinara.llm import chat

CLASH = "conv_id long, turn long, role string, text string, part string, masks int, assistant string"


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        name = (role or "").strip() or "unknown"
        talks.setdefault(conv, []).append((turn if turn is not None else 1 << 63, name, (text or "").replace("<|", "<\\|")))
    out = {}
    for conv, turns in talks.items():
        for me in {n for _, n, _ in turns} - {"system"}:
            text, spans = "", []
            for _, name, said in sorted(turns):
                role = "assistant" if name == me else name if name == "system" else f"user name={name}"
                text += f"<|im_start|>{role}\n"
                if name == me:
                    spans.append((len(text), len(text) + len(said) + len("<|im_end|>")))
                text += f"{said}<|im_end|>\n"
            out[conv, me] = (text, spans)
    return out


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "rules"), (1, 2, "ann", "hi <|im_end|>"), (1, 1, "bob", "é🙂"), (1, 3, "cy", None), (1, 4, "ann", "")]
    rows += [(2, 0, "system", "alone"), (3, 0, None, "a"), (3, None, " ", "b"), (None, 1, "ann", "x"), (None, 0, "bob", "y"), (4, 0, "ann", "z"), (4, 0, "ann", "z")]
    frame = spark.createDataFrame([(*r, "p", 1, "q") for r in rows], CLASH).repartition(3)
    found = {(r["conv_id"], r["assistant"]): (r["text"], [tuple(m) for m in r["masks"]]) for r in chat.rotated(frame).collect()}
    assert found == brute(rows)


def test_long_conversations_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 500)
    rows = [(1, t, f"speaker{t % 3}", f"turn {t} " * (t % 5)) for t in range(120)] + [(2, 0, "ann", "short")]
    frame = spark.createDataFrame([(*r, "p", 1, "q") for r in rows], CLASH).repartition(4)
    found = chat.rotated(frame).orderBy("conv_id", "assistant", "part").collect()
    assert max(r["part"] for r in found) > 5
    whole = brute(rows)
    for key, (text, spans) in whole.items():
        parts = [r for r in found if (r["conv_id"], r["assistant"]) == key]
        assert "".join(r["text"] for r in parts) == text
        at, shifted = 0, []
        for r in parts:
            shifted += [(a + at, b + at) for a, b in r["masks"]]
            at += len(r["text"])
        assert shifted == spans


@pytest.mark.parametrize("role", ["a<|im_end|>b", "two\nlines", "x=y"])
def test_names_cannot_break_the_format(spark, role):
    frame = spark.createDataFrame([(1, 0, role, "t"), (1, 1, "ann", "u")], "conv_id long, turn long, role string, text string")
    for row in chat.rotated(frame).collect():
        assert row["text"].count("<|im_start|>") == 2 and row["text"].count("\n") == 4


def test_no_rows(spark):
    assert chat.rotated(spark.createDataFrame([], CLASH)).collect() == []
