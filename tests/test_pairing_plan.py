import re

from tessera import book_queries
from tessera.operators import gate


def test_no_whole_text_is_joined_to_quote_from_it(spark, sf_dir, monkeypatch):
    held, pairing = [], gate.pairing
    monkeypatch.setattr(gate, "pairing", lambda entries, units: held.append(entries) or units)
    book_queries.gate_pairing(spark, sf_dir)
    assert pairing is not gate.pairing
    plan = held[0]._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join") :].splitlines()
    moved = [re.sub(r"substring\(text#\d+[^)]*\)", "", line) for line in below if "Project" in line]
    assert moved and not any("text#" in line for line in moved)
