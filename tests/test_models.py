import hashlib
import io
import json
import logging
import re

import pytest
from pyspark.sql import functions as F

from factloom.functions import logs, privacy
from factloom.plans import schema
from factloom.sources import models

FIELDS = [{"path": "party.bic", "label": "BIC", "kind": "BIC", "cardinality": "SINGLE"}, {"path": "party.account", "label": "Account", "kind": "ACCOUNT_NUMBER", "cardinality": "MULTI"}, {"path": "note", "label": "Note", "kind": "FREE_TEXT", "cardinality": "SINGLE"}, {"path": "note.more", "label": "More", "kind": "FREE_TEXT", "cardinality": "SINGLE"}]


def test_schema_of_a_record(spark):
    kind = schema.record_type(FIELDS)
    assert kind["party"].dataType["account"].dataType.elementType == schema.LEAF and kind["note"].dataType.names == ["more"]
    assert spark.createDataFrame([], kind).count() == 0
    strict = schema.json_schema(FIELDS)
    assert strict["required"] == ["note", "party"] and strict["properties"]["party"]["properties"]["account"]["type"] == "array"
    open_ = [strict]
    while open_:
        node = open_.pop()
        if node.get("type") == "object":
            assert node["required"] == list(node["properties"]) and node["additionalProperties"] is False
        open_ += [v for v in [*node.get("properties", {}).values(), node.get("items")] if isinstance(v, dict)]
    with pytest.raises(ValueError):
        schema.json_schema([])
    assert [schema.attribute_name(n) for n in ("class", "2nd", "", "bic")] == ["class_", "f_2nd", "field", "bic"]


def test_log_redaction_is_the_columns_redaction(spark):
    texts = ["pay DE89370400440532013000 to a.b@example.org", "BIC DEUTDEFF500, call +49 30 1234567 89", "account 123 456 789", "topsecret99 inside", "nothing here"]
    df = privacy.redact(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", ["topsecret99"])
    assert [r.t for r in df.orderBy("i").collect()] == [logs.redacted(t, ("topsecret99",)) for t in texts]
    out = io.StringIO()
    log = logs.logger("factloom.test", stream=out)
    assert logs.logger("factloom.test") is log and len(log.handlers) == 1
    log.warning("sent to %s", "a.b@example.org", extra={"detail": {"to": ["a.b@example.org", 7]}})
    said = json.loads(out.getvalue())
    assert "example.org" not in out.getvalue() and said["message"].startswith("sent to <EMAIL:") and said["detail"]["to"][1] == 7
    logging.getLogger("factloom.test").handlers.clear()


def test_tokens_are_not_redacted_again(spark):
    digits = [m for m in (f"a{i}@example.org" for i in range(3000)) if hashlib.sha256(("factloom-log-1" + m).encode()).hexdigest()[:12].isdigit()]
    texts = [f"to {m}, account 123 456 789, <EMAIL:123456789012>" for m in digits]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.t for r in privacy.redact(df, "t", [r"123 \E$1 Q"]).orderBy("i").collect()]
    assert len(digits) > 3 and got == [logs.redacted(t, (r"123 \E$1 Q",)) for t in texts]
    assert all(re.fullmatch(r"to <EMAIL:\d{12}>, account <ACCOUNT:[0-9a-f]{12}>, <EMAIL:<ACCOUNT:[0-9a-f]{12}>>", t) for t in got)
    assert [r.t for r in privacy.redact_all(df).orderBy("i").collect()] == got
    odd = spark.createDataFrame([(r"key 12x \E$1 Q!",)], "t string")
    assert privacy.redact(odd, "t", [r"12x \E$1 Q"]).first().t == logs.redacted(r"key 12x \E$1 Q!", (r"12x \E$1 Q",)) != r"key 12x \E$1 Q!"


def test_retries_quote_the_last_error_and_budgets_hold(spark):
    class Port:
        """Wrong twice per prompt, then right; a prompt with the word down cannot be reached."""

        def complete_json(self, *, system, user, schema, max_tokens):
            if "down" in user:
                raise ConnectionError("no route")
            self.seen = getattr(self, "seen", 0) + 1
            if "twice" in user and "(ValueError: 2)" not in user:
                raise ValueError(2 if "(ValueError: 1)" in user else 1)
            return {"said": user.split("\n")[1]}

    rows = [("a", 0, "plain"), ("a", 1, "twice"), ("a", 2, "over budget"), ("b", 0, "down")]
    df = spark.createDataFrame(rows, "document_id string, record_index int, prompt string").withColumn("schema", F.lit("{}"))
    got = {(r.document_id, r.record_index): r for r in models.answers(df, Port(), "system", per_document=6).collect()}
    assert json.loads(got["a", 0].json) == {"said": "plain"} and got["a", 0].calls == 1
    assert got["a", 1].calls == 3 and got["a", 1].rejected == "ValueError: 1; ValueError: 2" and got["a", 1].json
    assert got["a", 2].json is None and got["a", 2].calls == 0 and got["b", 0].rejected == "no route"
    used = {r.document_id: (r.calls, r.answered, r.unanswered) for r in models.usage(models.answers(df, Port(), "system", per_document=6)).collect()}
    assert used == {"a": (4, 2, 1), "b": (1, 0, 1)}
