from operator_table import covered


def test_every_operator_has_a_query():
    assert [operator for operator, names in covered().items() if not names] == []
