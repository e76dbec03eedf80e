"""What a message and a member cost: compiled code, few calls to the state."""

import re

from pulseloom.operators import parse
from pulseloom.session import configure
from pulseloom.streaming import hot


def test_parser_runs_compiled(spark, messages):
    """The JVM interprets methods of more than 8000 bytes; the parser's stage is larger than that."""
    parsed = parse.typed(messages({"content": "300B"}))
    code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        parsed._jdf.queryExecution(), "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) > 8000
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


class _Members:
    def __init__(self, held):
        self.held, self.asked = held, 0

    def getValue(self, key):
        self.asked += 1
        return (self.held[key[0]],) if key[0] in self.held else None

    def iterator(self):
        return iter([((device,), (last,)) for device, last in self.held.items()])


def test_many_members_are_read_at_once():
    """A batch that names many members of a gateway does not ask the state for each of them."""
    gateway = hot._Gateway(600_000, 10_000)
    gateway.members = _Members({f"d{n}": n for n in range(5000)})
    wanted = [f"d{n}" for n in range(1000, 7000)]
    assert gateway._held(wanted) == {f"d{n}": n for n in range(1000, 5000)} and gateway.members.asked == 0
    assert gateway._held(["d7", "none"]) == {"d7": 7} and gateway.members.asked == 2
