import io
import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.functions import grounding, text
from tidewater.operators import drift, learning
from tidewater.plans import agent, features, guards, probes, protocol, serving
from tidewater.sources import archive, snapshots
from tidewater.sources.snapshots import Contract, ContractError, SnapshotStore

T0 = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture
def gate(tmp_path):
    answers = {"predict": lambda **k: {"breach_risk": 0.38462, "model_version": 2}, "drop": lambda **k: {}, "versions": lambda: {"training_data_delta_versions": {"events": 92}}, "broken": lambda **k: 1 / 0}
    return serving.Gateway(answers, {"predict", "versions", "broken"}, tmp_path / "audit.jsonl")


def test_an_agent_answers_what_tools_returned(gate):
    model = agent.transcript_model([{"tool": "predict", "arguments": {"pr_number": 1}}, {"answer": "The score is 0.385."}])
    got = agent.ask(model, gate, "How risky?")
    assert (got.state, got.answer, got.turns) == ("answered", "The score is 0.385.", 2) and got.verdict.grounded


def test_one_retry_then_the_answer_is_withheld(gate):
    wrong, right = {"answer": "The score is 0.9."}, {"answer": "The score is 0.38."}
    call = {"tool": "predict"}
    seen = []
    replay = agent.transcript_model([call, wrong, right])
    got = agent.ask(lambda m, t: seen.append([*m]) or replay(m, t), gate, "?")
    assert (got.state, got.turns) == ("answered", 3) and "0.9 is in no tool return" in seen[-1][-1]["content"]
    got = agent.ask(agent.transcript_model([call, wrong, wrong]), gate, "?")
    assert (got.state, got.answer) == ("ungrounded", None) and got.verdict.failures


def test_the_budget_of_turns_covers_the_retry(gate):
    got = agent.ask(agent.transcript_model([{"tool": "predict"}] * 9), gate, "?", turns=4)
    assert (got.state, got.answer, got.turns) == ("turn_limit", None, 4)
    got = agent.ask(agent.transcript_model([{"tool": "predict"}, {"answer": "It is 7."}, {"answer": "no"}]), gate, "?", turns=2)
    assert (got.state, got.turns) == ("turn_limit", 2)
    denied = agent.ask(agent.transcript_model([{"tool": "drop"}, {"answer": "Nothing."}]), gate, "?")
    assert denied.returns[0][1]["reason"] == "not_allowed"


def test_endpoints_fall_back_and_are_audited(tmp_path):
    def down(messages, tools):
        raise TimeoutError("slow")

    both = agent.Endpoints({"a": down, "b": lambda m, t: {"answer": "x"}}, tmp_path / "e.jsonl")
    assert both([], []) == {"answer": "x"} and both.preflight() == {"a": False, "b": True}
    assert [(r["endpoint"], r["ok"], r.get("preflight")) for r in both.records()] == [("a", False, None), ("b", True, None), ("a", False, True), ("b", True, True)]
    with pytest.raises(agent.Unavailable):
        agent.Endpoints({"a": down}, tmp_path / "e.jsonl")([], [])
    with pytest.raises(ValueError):
        agent.Endpoints({}, tmp_path / "e.jsonl")


def test_protocol_lists_and_calls_reviewed_tools(gate):
    specs = [protocol.ToolSpec("predict", "d", {"repo_id": "integer"}), protocol.ToolSpec("drop", "d", {}), protocol.ToolSpec("versions", "d", {}), protocol.ToolSpec("broken", "d", {})]
    server = protocol.Server(gate, specs)

    def say(method, id=1, **params):
        return server.handle({"jsonrpc": "2.0", "id": id, "method": method, "params": params})

    assert say("initialize")["result"]["protocolVersion"] == protocol.VERSION and say("ping")["result"] == {}
    tools = say("tools/list")["result"]["tools"]
    assert [t["name"] for t in tools] == ["predict", "versions", "broken"] and all(t["annotations"]["readOnlyHint"] for t in tools)
    assert say("tools/call", name="predict", arguments={"repo_id": 3})["result"]["structuredContent"]["breach_risk"] == 0.38462
    for bad in ({"name": "drop"}, {"name": "predict"}, {"name": "predict", "arguments": {"repo_id": "3"}}, {"name": "predict", "arguments": {"repo_id": True}}, {"name": "versions", "arguments": {"x": 1}}):
        assert say("tools/call", **bad)["error"]["code"] == protocol.BAD_PARAMS
    broken = say("tools/call", name="broken")["result"]
    assert broken["isError"] and broken["structuredContent"]["reason"] == "tool_failed"
    assert say("nothing")["error"]["code"] == protocol.NO_METHOD and server.handle([])["error"]["code"] == protocol.INVALID_REQUEST
    assert server.handle({"jsonrpc": "2.0", "method": "notifications/initialized"}) is None
    out = io.StringIO()
    server.serve(['{"jsonrpc": "2.0", "id": 7, "method": "ping"}\n', "\n", "{oops\n"], out)
    assert [json.loads(x).get("id") for x in out.getvalue().splitlines()] == [7, None]
    assert [r["outcome"] for r in gate.records()] == ["ok", "error"]


def plan(**changes):
    return {"resource_changes": [{"address": a, "change": {"actions": list(actions)}} for a, actions in changes.items()]}


def test_plans_stay_within_their_targets():
    assert guards.guard("up", plan(a=["create"], b=["no-op"], c=["read"]), ["a"]) == {"a": ("create",)}
    for stage, document, said in [("up", plan(a=["delete", "create"]), "would delete"), ("up", plan(z=["update"]), "not asked for"), ("sync", plan(a=["update"]), "though nothing should"), ("down", plan(a=["create"]), "would create"), ("down", plan(z=["delete"]), "not asked for")]:
        with pytest.raises(guards.PlanRefused, match=said):
            guards.guard(stage, document, ["a"])
    assert guards.guard("down", plan(a=["delete"]), ["a"]) and guards.problems("up", plan(), []) == ["no targets: the plan covers everything"]
    state = {"values": {"root_module": {"resources": [{"address": "a"}], "child_modules": [{"resources": [{"address": "m.b"}]}]}}}
    assert guards.left_over(state, ["a", "m.b", "c"]) == ["a", "m.b"] and guards.left_over({}, ["a"]) == []


def test_constraints_evolve(spark, tmp_path):
    t = SnapshotStore(spark, f"file://{tmp_path}").table("t")
    t.write(spark.createDataFrame([(1, 5), (2, 50)], "id long, v long"))
    kinds = {"id": "bigint", "v": "bigint"}
    assert t.apply_constraints(Contract(kinds, ["id"], {"small": "v < 100"})) == {"added": ["id_not_null", "small"], "replaced": [], "dropped": []}
    before = t.version
    assert not any(t.apply_constraints(Contract(kinds, ["id"], {"small": "V <  100"})).values()) and t.version == before
    with pytest.raises(ContractError, match="small: 1"):
        t.apply_constraints(Contract(kinds, ["id"], {"small": "v < 10"}))
    assert t.constraints()["small"] == "v < 100" and t.version == before
    for rows in ([(3, 500)], [(None, 1)], [(3, None)]):
        with pytest.raises(ContractError):
            t.append(spark.createDataFrame(rows, "id long, v long"))
    assert t.apply_constraints(Contract(kinds, [], {"small": "v < 1000"})) == {"added": [], "replaced": ["small"], "dropped": ["id_not_null"]}
    t.append(spark.createDataFrame([(None, 500)], "id long, v long"))
    assert t.read().count() == 3 and t.read(before).count() == 2 and t.changes(before).count() == 1


def test_names_and_locations(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    assert store.locations().count() == 0
    store.table("a").write(spark.range(2))
    store.table("a").write(spark.range(5))
    assert [r["full_name"] for r in store.locations().collect()] == ["a"]
    assert (store.read("a").count(), store.read("a", {"a": 0}).count()) == (5, 2)
    spark.range(1).write.mode("overwrite").parquet(f"{tmp_path}/ext")
    snapshots.register(spark, "ext_table", f"{tmp_path}/ext")
    try:
        got = {r["full_name"]: r["storage_path"] for r in snapshots.catalogue_locations(spark, ["default"]).collect()}
        assert got["default.ext_table"].endswith("/ext")
    finally:
        spark.sql("DROP TABLE ext_table")


def test_tree_contributions_add_up_to_the_model_that_scores(spark):
    rows = [(1, k, float(k % 17), float(k % 5) if k % 9 else None, k % 17 > 9) for k in range(400)]
    frame = spark.createDataFrame(rows, "repo_id long, pr_number long, a double, b double, breach boolean")
    model = learning.train_classifier(frame, frame, ["a", "b"], candidates=("default",), trees=4, depth=3)
    got = learning.tree_contributions(frame, model, ["pr_number"]).join(learning.score(frame, model).select("pr_number", "score"), "pr_number").collect()
    assert len(got) == 400
    for r in got:
        assert r["a"] + r["b"] + r["baseline"] == pytest.approx(r["raw"], abs=1e-9)
        assert 1 / (1 + 2.718281828459045 ** (-2 * r["raw"])) == pytest.approx(r["score"], abs=1e-9)
    assert max(abs(r["a"]) for r in got) > max(abs(r["b"]) for r in got)


def test_identities(spark):
    rows = [(1, "mail a.b@corp.org and x@example.com\nbuildbox saw c@d.io, c@d.io"), (2, "abfss://raw@store.dfs.core.windows.net buildboxes"), (3, None), (4, "")]
    got = sorted(tuple(r) for r in text.identity_findings(spark.createDataFrame(rows, "id long, t string"), ["id"], "t", ["buildbox"]).collect())
    assert got == [(1, 1, "email", "a.b@corp.org"), (1, 2, "email", "c@d.io"), (1, 2, "email", "c@d.io"), (1, 2, "identifier", "buildbox")]
    assert text.identifiers_of("box.local", "runner") == ["box", "box.local"] and text.identifiers_of("ab", "Root") == []


def test_paths_renames_and_missing(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":{"d":2},"e":[1]},"f":null}',), ("{bad",), ("[1]",), (None,)], "j string")
    assert [r[0] for r in df.select(text.json_paths(F.col("j"))).collect()] == [["a", "b", "f", "b.c", "b.e"], None, None, None]
    rows = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 2, "y"), (1, "b", 3, "z"), (2, "q", 1, "w"), (None, "r", 1, "v")], "k long, n string, created_at long, event_id string")
    assert [tuple(r) for r in text.renames_in(rows, "k", "n").collect()] == [(1, "a", "b", 3)]
    odd = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "a double, b string")
    assert [r[0] for r in odd.select(drift.missing_names(odd.schema, ["b", "a"])).collect()] == [[], ["b", "a"], ["a"]]
    early, late = (spark.createDataFrame(r, "k long, x long, y long") for r in ([(1, 1, None), (2, 1, 1)], [(1, 2, None), (2, 1, None), (3, 1, 1)]))
    assert {r["k"]: r["moved"] for r in features.moved_names(early, late, ["k"], ["x", "y"]).collect()} == {1: ["x"], 2: ["y"]}


def test_probes(spark, tmp_path):
    import gzip

    path = tmp_path / "2024-01-01-3.json.gz"
    path.write_bytes(gzip.compress(b'{"id":"1"}\n{"id":"2"}\n'))
    got = probes.calibrate_day(spark, date(2024, 1, 1), lambda d: [archive.Fetched(d, 3, archive.Outcome.OK, str(path), 50), archive.Fetched(d, 4, archive.Outcome.ABSENT)], f"file://{tmp_path}/lake", T0)
    assert (got["hours"], got["rows"], got["compressed_bytes"]) == (1, 2, 50) and got["rows_per_second"] > 0
    with pytest.raises(LookupError):
        probes.calibrate_day(spark, date(2024, 1, 1), lambda d: [], str(tmp_path), T0)
    rate = probes.encode_rate(lambda: lambda batch: [[0.0]] * len(batch), ["a"] * 10, corpus=100, batch=3)
    assert rate["texts"] == 10 and rate["projected_hours"] > 0
    source = tmp_path / "all.jsonl"
    source.write_text("".join(('{"i": %d}\n' % k) if k != 4 else "{broken\n" for k in range(11)))
    assert probes.sample_lines(source, tmp_path / "some.jsonl", 2) == 5 and '{"i": 10}' in (tmp_path / "some.jsonl").read_text()
    states, ticks = [], iter(range(1000))
    found = probes.paired_runs({"x": lambda: None}, states.append, pairs=2, clock=lambda: next(ticks))
    assert states == [False, True, False, True, False] and found["x"]["mean"] == 1.0
    trace = tmp_path / "t.json"
    trace.write_text(json.dumps({"answer": "The score is 0.4.", "returns": [{"tool": "predict", "content": {"breach_risk": 0.4}}]}))
    assert probes.grounding_panel(trace).grounded
    assert [x["feature"] for x in probes.contribution_panel({"a": 1.0, "b": -3.0}, 0.5)] == ["b", "a", "baseline"]


def test_similar_pull_requests_refuse(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}")
    tools = serving.Tools.__new__(serving.Tools)
    tools.spark, tools.store, tools.versions = spark, store, {}
    ask = lambda n, h, **k: tools.similar_prs(serving.Request(1, n, T0 + timedelta(hours=h)), 2, **k)
    assert ask(1, 5)["reason"] == "no_embeddings"
    rows = [(f"pr:1:{k}", T0 + timedelta(hours=k), [float(k), 0.0]) for k in range(5)]
    store.table("embeddings").write(spark.createDataFrame(rows, "entity_key string, event_time timestamp, embedding array<double>"))
    assert [n["entity_key"] for n in ask(2, 10)["neighbours"]] == ["pr:1:1", "pr:1:3"]
    assert ask(4, 4)["reason"] == "not_embedded"  # strictly before
    assert ask(2, 10, freshest=timedelta(hours=1))["reason"] == "stale_embeddings" and "neighbours" in ask(2, 4.5, freshest=timedelta(hours=2))


# ---- grounding, by what it must accept and refuse


@pytest.mark.parametrize(
    ("literal", "value", "how"),
    [("0.385", 0.38462, "rounded"), ("0.384", 0.38462, "truncated"), ("0.4", 0.38462, None), ("38.5%", 0.38462, "rounded"), ("38.46%", 38.46, "exact"), ("1,204", 1204, "exact"), ("12", 12.4, None), ("-1.2", -1.25, "rounded"), ("-1.25", -1.251, "rounded"), ("1.2", 1.29, "truncated"), ("2.5e3", 2500, "exact"), ("1.25", 1.26, None)],
)
def test_what_a_written_number_stands_for(literal, value, how):
    assert grounding.stands_for(literal, grounding.decimal(value)) == how


def test_numbers_are_found_in_nested_returns_only():
    returns = [("t", {"a": [{"b": "7"}, 3.5, True, None, "x", float("nan")]})]
    assert [(p, float(v)) for p, v in grounding.flat(returns)] == [("t.a[0].b", 7.0), ("t.a[1]", 3.5)]
    assert grounding.check("Seven is 7 and 3.5, not 1.", returns).failures == ["1 is in no tool return"]
    assert grounding.check("Version v2 of pr-5x said `9` at 2024-01-01 10:00Z.", []).grounded


@pytest.mark.parametrize(
    ("sentence", "said"),
    [("size raises it", "increases_risk"), ("size pushes it", None), ("size pushes up the risk", "increases_risk"), ("size drives down the risk", "decreases_risk"), ("size is lower and raises it", None), ("a higher size", "increases_risk")],
)
def test_directions(sentence, said):
    found = grounding.check(sentence, [("explain", {"contributions": [{"feature": "size", "contribution": 0.5}]})]).directions
    assert [d["said"] for d in found] == ([said] if said else [])


def test_a_claim_must_come_from_its_own_field():
    returns = [("versions", {"training_data_delta_versions": {"events": 4}, "model_version": 9}), ("predict", {"breach_risk": 0.25, "read_delta_versions": {"events": 7}})]
    for answer, good in [("The model is version 9, trained on version 4, reading version 7.", True), ("The model is version 4.", False), ("Trained on version 7.", False), ("As of version 4.", False), ("The breach risk was 0.25.", True), ("The baseline is 0.25.", False)]:
        assert grounding.check(answer, returns).grounded == good, answer
