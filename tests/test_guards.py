import json
import re

import pytest

from cartwheel.functions import text as X
from cartwheel.plans import guards as G
from conftest import by_key


@pytest.mark.parametrize("text, email, phone", [
    ("write to a.b+c@mail.example.com now", True, False),
    ("WRITE TO A@B.CO", True, False),
    ("a@b", False, False),
    ("call 555-123-4567", False, True),
    ("call 5551234567", False, True),
    ("call 555.123-4567.", False, True),
    ("call 555123456", False, False),
    ("id 15551234567", False, False),
    ("éa@b.com", False, False),
    ("é a@b.com", True, False),
    ("x@y.comé", False, False),
])
def test_pii(frame, text, email, phone):
    got = G.pii_screen(frame("q string", (text,)), "q").first()
    assert (got.has_email, got.has_phone, got.has_pii) == (email, phone, email or phone)
    assert email == bool(re.search(X.PII_PATTERNS[0], text, re.IGNORECASE))
    assert phone == bool(re.search(X.PII_PATTERNS[1], text, re.IGNORECASE))


@pytest.mark.parametrize("sql, reason", [
    ("SELECT updated_at FROM d.dataset_marts.mart_sales", ""),
    ("update dataset_marts.mart_sales set x = 1", "Forbidden keyword: UPDATE"),
    ("select 1; Drop table dataset_marts.nope", "Forbidden keyword: DROP"),
    ("create table x; delete from y", "Forbidden keyword: DELETE"),  # order of the list
    ("SELECT * FROM dataset_marts.mart_customers",
     "Table not in allow-list: mart_customers"),
    ("SELECT * FROM Dataset_Marts.DIM_DATE JOIN dataset_marts.Other", 
     "Table not in allow-list: Other"),
    ("SELECT 1", ""),
])
def test_sql_guard(frame, sql, reason):
    got = G.sql_guard(frame("sql string", (sql,)), "sql").first()
    assert (got.reason, got.is_valid) == (reason, reason == "")


FULL = json.dumps({"sql": "SELECT 1", "explanation": 'say "x"\nnow', "tables_used": ["a", "b"]})


@pytest.mark.parametrize("raw", [
    FULL, f"```json\n{FULL}\n```", f" \n{FULL}\n ", f"Sure! {FULL} Anything else?"])
def test_replies_that_can_be_read(frame, raw):
    got = G.parse_answer(frame("raw string", (raw,)), "raw").first()
    assert (got.sql, got.explanation, got.tables_used, got.error) == (
        "SELECT 1", 'say "x"\nnow', ["a", "b"], None)


@pytest.mark.parametrize("raw, error", [
    ("no json here", "No JSON in response: no json here"),
    ("  " + "x" * 400, "No JSON in response: " + "x" * 300),
    ('{"sql": cut}', 'Failed to parse response: {"sql": cut}'),
    ('{"sql": "a"} and {"sql": "b"}', 'Failed to parse response: {"sql": "a"} and {"sql": "b"}'),
    ("{'sql': 'a'}", "Failed to parse response: {'sql': 'a'}"),
])
def test_replies_that_cannot(frame, raw, error):
    got = G.parse_answer(frame("raw string", (raw,)), "raw").first()
    assert (got.sql, got.tables_used, got.error) == (None, None, error)


def test_missing_fields_get_defaults(frame):
    got = by_key(G.parse_answer(frame("id int, raw string", (1, "{}"), (2, '{"sql": "S"}')), "raw"),
                 "id")
    assert got[1]["sql"] == "" and got[1]["tables_used"] == [] and got[1]["error"] is None
    assert got[2]["sql"] == "S" and got[2]["explanation"] is None


@pytest.mark.parametrize("question, raw, error", [
    ("mail a@b.com", '{"sql": "DROP x"}', G.PII_REFUSAL),
    ("how many", "no json", "No JSON in response: no json"),
    ("how many", '{"sql": "drop x"}', "SQL validation failed: Forbidden keyword: DROP"),
    ("how many", '{"sql": "select 1 from dataset_marts.x"}',
     "SQL validation failed: Table not in allow-list: x"),
    ("how many", '{"sql": "select 1 from dataset_marts.dim_date"}', None),
])
def test_verdicts_name_the_first_reason(frame, question, raw, error):
    df = frame("question string, raw string", (question, raw))
    got = G.answer_verdicts(df, "question", "raw").first()
    assert got.error == error
