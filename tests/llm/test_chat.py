from kinmatch.llm.chat import assemble, perspectives

SCHEMA = "conv_id long, turn long, role string, text string, perspective string, block long"


def rendered(turns, who):
    text, loss = "", []
    for speaker, said in turns:
        name = "assistant" if speaker == who else "system" if speaker == "system" else f"user name={speaker}"
        text += f"<|im_start|>{name}\n"
        if speaker == who:
            loss.append((len(text), len(text) + len(said) + len("<|im_end|>")))
        text += f"{said}<|im_end|>\n"
    return text, loss


def test_every_perspective(spark):
    turns = [("system", "be good"), ("ann", "hé"), ("bob", ""), ("ann", "😀 yes"), ("cy", "x" * 500)] + [("bob", f"m{i}") for i in range(150)]
    rows = [(1, i, s, t, "p", 9) for i, (s, t) in enumerate(turns)]
    got = {r["perspective"]: (r["text"], [tuple(x) for x in r["loss"]]) for r in assemble(perspectives(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {who: rendered(turns, who) for who in ("ann", "bob", "cy")}


def test_nulls_ties_and_system_only(spark):
    rows = [(1, None, "a", None, "p", 9), (1, 1, None, "x", "p", 9), (1, 1, None, "x", "p", 9), (1, 1, "a", "x", "p", 9), (2, 0, "system", "s", "p", 9), (None, 5, "a", "n", "p", 9)]
    got = {(r["conv_id"], r["perspective"]): r["text"] for r in assemble(perspectives(spark.createDataFrame(rows, SCHEMA))).collect()}
    order = [("a", ""), ("a", "x"), ("unknown", "x"), ("unknown", "x")]
    assert got == {(1, "a"): rendered(order, "a")[0], (1, "unknown"): rendered(order, "unknown")[0], (None, "a"): rendered([("a", "n")], "a")[0]}


def test_nothing_and_no_python(spark):
    out = perspectives(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
