"""Groups within groups, against plain Python."""

from __future__ import annotations

from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st

from conftest import rows
from wardline.operators.entitlements import inherited_entitlements, principal_access
from wardline.operators.membership import containing_groups

SCHEMA = "displayName string, members array<string>, entitlements array<string>"


def groups_of(spark, inside):
    """Groups with the members listed; a group passes on one entitlement of its own name."""
    return spark.createDataFrame([(g, m, [f"on-{g}"]) for g, m in inside.items()], SCHEMA)


def expected(inside):
    found = set()
    for group in inside:
        reached, todo = set(), [group]
        while todo:
            own = todo.pop()
            for above, members in inside.items():
                if own in members and above not in reached:
                    reached.add(above)
                    todo.append(above)
        found |= {(group, above) for above in reached - {group}}
    return sorted(found)


def test_a_chain_of_forty_takes_few_rounds(spark, monkeypatch):
    inside = {f"g{k:02}": [f"g{k + 1:02}", "somebody"] for k in range(40)}
    assert rows(containing_groups(groups_of(spark, inside))) == expected(inside)
    users = spark.createDataFrame([("u", ["g39"])], "userId string, groups array<string>")
    inherited = inherited_entitlements(users, groups_of(spark, inside), nested=True).first()
    assert len(inherited["inherited_entitlements"]) == 40
    assert len(inherited_entitlements(users, groups_of(spark, inside)).first()[1]) == 1


def test_a_cycle_ends(spark):
    inside = {"a": ["b"], "b": ["c"], "c": ["a", "c"], "d": ["a"], "e": [None, "nobody"]}
    assert rows(containing_groups(groups_of(spark, inside))) == expected(inside)


def test_no_groups_and_groups_without_members(spark):
    assert containing_groups(groups_of(spark, {"a": []}).where("false")).count() == 0
    nulls = spark.createDataFrame([("a", None, None), (None, ["a"], ["x"])], SCHEMA)
    assert containing_groups(nulls).where("`group` IS NULL").count() == 0


def test_access_through_nested_groups(spark):
    users = spark.createDataFrame(
        [("x", ["b"], ["own"], "1"), ("y", ["a"], ["own"], "2"), ("z", ["e"], ["own"], "3")],
        "userName string, groups array<string>, entitlements array<string>, userId string",
    )
    groups = groups_of(spark, {"a": ["b"], "b": [], "e": []}).where("displayName <> 'e'")
    found = rows(principal_access(users, groups, nested=True))
    assert found == [
        ("x", "b", "on-a"),
        ("x", "b", "on-b"),
        ("x", "b", "own"),
        ("y", "a", "on-a"),
        ("y", "a", "own"),
    ]


NAMES = st.sampled_from("abcdefgh")


@examples(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(NAMES, st.lists(NAMES, max_size=4), min_size=1))
def test_against_plain_python(spark, inside):
    assert rows(containing_groups(groups_of(spark, inside))) == expected(inside)
