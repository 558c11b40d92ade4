"""Several copies of a benchmark item in one document."""

from __future__ import annotations

from trustgate.llm import templates


def test_each_copy_of_an_item_has_its_own_binding():
    item = "a train travels 60 km in 2 hours and then 90 km in 3 hours more"
    other = item.replace("60", "50").replace("2", "4").replace("90", "70").replace("3", "5")
    equal = item.replace("60", "80").replace("90", "80")
    index = templates.Index([(1, item)])
    (whole,) = index.leaks([item])
    for text in (f"{item} and {other}", f"{other} and {item}", f"{item} . {other} . {equal}"):
        assert index.leaks([text]) == [whole]
    (found,) = index.leaks([equal])
    assert found[3] == whole[3] and found[5]
    edited = "a train travels 60 km in 2 hours each and then goes on 90 km in 3 hours more"
    assert len(index.leaks([f"{edited} {other}"])) == len(index.leaks([other]))
