"""Branches of the attribution routes (FIXTURES.md §4, A2-A6)."""

from helpers import with_rows

from dimloom.operators import attributions as A

USER = ("uX", "uuid-x", "Xa", "Xb", "x@example.com", "CL", None, None, None, None, True, False, None, None)


def _user(uid, email, typ):
    return (uid, f"uuid-{uid}", "F", "L", email, typ, None, None, None, None, True, False, None, None)


def test_missing_classroom_keeps_null_row_for_members_but_not_for_invitations(spark):
    T = with_rows(spark,
                  learner_classroom_membership=[("u1", "nope")],
                  educator_invitation_record=[("bob@example.com", "nope")],
                  educator_classroom_membership=[], user_join_record=[])
    learner = A.route_learner(T).collect()
    assert len(learner) == 1 and learner[0].user_id == "u1" and learner[0].classroom_id is None
    assert A.route_invited(T).count() == 0


def test_invitation_email_matching_rules(spark):
    users = [_user("n", "n@example.com", None), _user("il", "il@example.com", "IL"),
             _user("up", "up@example.com", "CL"), _user("tab", "tab@example.com", "E"),
             _user("nul", None, "CL")]
    invites = [("n@example.com", "cls101"), ("il@example.com", "cls101"), ("  UP@EXAMPLE.com ", "cls101"),
               ("\ttab@example.com ", "cls101"), (None, "cls101")]
    T = with_rows(spark, user_core=users, educator_invitation_record=invites)
    got = sorted(r.user_id for r in A.route_invited(T).collect())
    assert got == ["tab", "up"]


def test_sponsor_join_route(spark):
    users = [_user("a", "a@x", "CL"), _user("b", "b@x", "IL"), _user("c", "c@x", None)]
    joins = [("a", "userjoins", "invite-abc123"), ("a", "userleaves", "invite-xyz789"),
             ("b", "userjoins", "invite-abc123"), ("c", "userjoins", "invite-abc123"),
             ("a", "userjoins", "missing")]
    T = with_rows(spark, user_core=users, user_join_record=joins)
    rows = A.route_sponsor_join(T).collect()
    assert [(r.user_id, r.sponsor_code, r.site_id, r.classroom_id) for r in rows] == [("a", "ABC123", "site1", None)]


def test_stack_keeps_cross_group_duplicates_and_drops_in_group_ones(spark):
    T = with_rows(spark,
                  learner_classroom_membership=[("u9", "cls202"), ("u9", "cls202")],
                  educator_classroom_membership=[("u9", "cls202")],
                  educator_invitation_record=[], user_join_record=[])
    rows = A.user_attributions(T).collect()
    assert len(rows) == 2 and {r.classroom_id for r in rows} == {"cls202"}


def test_several_codes_per_sponsor_fan_out(spark):
    codes = [("i1", "C1", "spon001", "site1"), ("i2", "C2", "spon001", "site1")]
    T = with_rows(spark, sponsor_invite_code=codes, learner_classroom_membership=[("u1", "cls101")],
                  educator_classroom_membership=[], educator_invitation_record=[], user_join_record=[])
    assert sorted(r.sponsor_code for r in A.user_attributions(T).collect()) == ["C1", "C2"]
    best = A.best_attribution(T).collect()
    assert len(best) == 1 and best[0].sponsor_code == "C1"
