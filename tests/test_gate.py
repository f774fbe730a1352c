import random

from loamline.operators import gate, refine


def sample(**x):
    return {"seq": 0, "instruction": "Do it well", "input": "File: a", "output": "\n".join(f"line {i} of some text" for i in range(5)), "type": "code_reference", "source": "docs/a.md", "topic": "t"} | x


SCHEMA = "seq long, instruction string, input string, output string, type string, source string, topic string"


def reasons(spark, rows, cfg=None):
    rows = [r | {"seq": i} for i, r in enumerate(rows)]
    df = spark.createDataFrame([tuple(r[c.split(" ")[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    return [r["rejection_reason"] for r in gate.gated(df, cfg).orderBy("seq").collect()]


def test_reasons(spark):
    cfg = gate.GateConfig(min_chars=50, need_input=["yaml_reference"], min_by_type={"yaml_reference": 20}, denied_topics=["secret"], doc_sources=["docs/"], max_streak=40)
    prose = "some letters here " * 12 + "\nmore\nlines"
    rows = [
        (sample(instruction="Show me the implementation of the class is in the file x", output=prose + "1"), "invalid_symbol_kind_prompt"),
        (sample(output="\n".join(map(str, range(1, 45)))), "numeric_line_streak"),
        (sample(output="Instruction: a\nInput: b\nOutput: c\n" + prose), "prompt_wrapper_echo"),
        (sample(output=prose + "\n```\n1\n2\n3\n4\n5\n6\n7\n8\n```"), "numeric_code_block_artifact"),
        (sample(type="yaml_reference", input=" ", instruction="yaml configuration"), "missing_context_input"),
        (sample(type="yaml_reference", instruction="other"), "yaml_instruction_output_mismatch"),
        (sample(type="yaml_reference", instruction="yaml configuration", output="a: 1"), "too_short"),
        (sample(type="doc_summary", instruction="Explain the following topic: x", topic="A Secret", output=prose), "doc_topic_denied"),
        (sample(type="doc_summary", instruction="Explain the following topic: x", source="web/a", output=prose), "doc_source_not_allowed"),
        (sample(type="doc_summary", instruction="Explain the following topic: x", output=prose), "poor_instruction"),
        (sample(instruction="in repos/ it is", output=prose + "7"), "path_leakage_token"),
        (sample(output="same\n" * 30), "repetitive_output"),
        (sample(output="Sign in please " + prose), "boilerplate_content"),
        (sample(output="<?php\n" + prose, source="a/b.php"), "missing_namespace_in_php"),
        (sample(output="<?php\n" + prose, source="a/b.module", instruction="module"), None),
        (sample(output="x" * 60), "insufficient_detail"),
    ]
    assert reasons(spark, [r for r, _ in rows], cfg) == [x for _, x in rows]


def sequential(rows, n):
    """The state of the rules that look back, kept row by row."""
    seen, pairs, out = set(), {}, []
    for ins, output, bad in rows:
        mine = pairs.setdefault(ins, set())
        if output not in mine and len(mine) >= n:
            out.append("ambiguous_instruction_input_pair")
        elif output in seen:
            out.append("near_duplicate_content")
        elif bad:
            out.append("boilerplate_content")
        else:
            seen.add(output)
            mine.add(output)
            out.append(None)
    return out


def test_state_against_one_pass(spark):
    r = random.Random(3)
    for n in (1, 2):
        plan = [(f"i{r.randrange(5)}", r.randrange(9), r.random() < 0.2) for _ in range(60)]
        text = lambda k, bad: ("cookie " if bad else "") + f"kind {k}\n" + "text of some length " * 9 + "\nend"
        rows = [sample(instruction=i, output=text(k, b)) for i, k, b in plan]
        assert reasons(spark, rows, gate.GateConfig(min_chars=50, outputs_per_pair=n)) == sequential([(x["instruction"], x["output"], b) for x, (_, _, b) in zip(rows, plan, strict=True)], n)


def test_refinement_helpers():
    limits = refine.share_limits({"a": 90, "b": 10}, 0.45)
    assert set(limits) <= {"a", "b"} and limits["a"] < 90 and all(n > 0 for n in limits.values())
    got = dict(refine.assign_groups([(f"s{i}", 10) for i in range(10)], (0.8, 0.1)))
    sizes = {k: list(got.values()).count(k) for k in set(got.values())}
    assert len(got) == 10 and sizes == {"train": 8, "valid": 1, "test": 1}
    assert refine.valid_patterns({"a": ["(", "b"]}) == {"a": ["b"]} and refine.valid_patterns(None) == refine.CATEGORIES
