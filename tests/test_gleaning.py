from __future__ import annotations

import zlib

from quillstack.sources import gleaning as G


def answer(messages):
    """A model that depends on the whole conversation; it notes each call in a file if the last message names one."""
    h = zlib.crc32(repr(messages).encode())
    if messages[0]["content"] == "broken":
        raise ConnectionError("gone")
    if messages[-1]["content"] == "ANY?":
        return ("YES" if h % 2 else '"yes"') if h % 3 else "no"
    if messages[0]["content"] == "faulty" and len(messages) > 2:
        return "**ERROR** busy"
    return f"<think>hm</think>r{h % 1000};"


def plain(prompt, rounds):
    """The loop for one prompt."""
    say = lambda m: answer(m).split("</think>")[-1]
    history = [{"role": "user", "content": prompt}]
    try:
        result, n = say(history), 0
        history += [{"role": "assistant", "content": result}, {"role": "user", "content": "MORE"}]
        for k in range(rounds):
            got = say(history)
            if "**ERROR**" in got:
                raise ValueError(got)
            result, n = result + got, n + 1
            if k + 1 == rounds:
                break
            history += [{"role": "assistant", "content": got}, {"role": "user", "content": "ANY?"}]
            if say(history).strip().strip('"').strip("'").lower() != "yes":
                break
            history += [{"role": "assistant", "content": "yes"}, {"role": "user", "content": "MORE"}]
        return result, n, False
    except ConnectionError:
        return "", 0, True
    except ValueError:
        return result, n, True


def test_equals_a_loop(spark, tmp_path):
    prompts = [f"p{i}" for i in range(12)] + ["p3", "broken", "faulty"]
    chunks = spark.createDataFrame(list(enumerate(prompts)), "id long, prompt string")
    got = G.glean(chunks, answer, str(tmp_path / "cache"), "MORE", "ANY?", rounds=3).collect()
    assert {r.id: (r.result, r.gleanings, r.error is not None) for r in got} == {i: plain(p, 3) for i, p in enumerate(prompts)}
    assert {r.gleanings for r in got} == {0, 1, 2, 3}


def test_no_repeated_call(spark, tmp_path):
    """Equal conversations are one call, and a second run makes none at all."""
    calls, cache = tmp_path / "calls", str(tmp_path / "cache")
    calls.mkdir()

    def noted(messages):
        import uuid

        (calls / uuid.uuid4().hex).write_text(str(zlib.crc32(repr(messages).encode())))
        return answer(messages)

    chunks = spark.createDataFrame([(i, f"p{i % 3}") for i in range(9)], "id long, prompt string")
    first = sorted(tuple(r) for r in G.glean(chunks, noted, cache, "MORE", "ANY?", rounds=2).collect())
    made = [p.read_text() for p in calls.iterdir()]
    assert len(made) == len(set(made)) and 6 <= len(made) <= 12
    assert sorted(tuple(r) for r in G.glean(chunks, noted, cache, "MORE", "ANY?", rounds=2).collect()) == first
    assert len(list(calls.iterdir())) == len(made)
