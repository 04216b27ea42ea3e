"""The source project's sample rows (13 tables), used as the golden fixture.

Fixed values: copied as data so the goldens of FIXTURES.md can be checked.
"""

import datetime as dt

D = dt.date
TS = dt.datetime

AS_OF = dt.date(2026, 3, 10)

ROWS = {
    "user_core": [
        ("u001", "uuid-001", "Alice", "Smith", "alice@example.com", "IL", "White", "Woman", None, TS(2024, 1, 10, 9, 0), True, False, D(1995, 5, 20), "locA"),
        ("u002", "uuid-002", "Bob", "Johnson", "bob@example.com", "CL", "Asian", "Man", None, TS(2024, 2, 15, 14, 30), True, False, D(2000, 11, 3), "locB"),
        ("u003", "uuid-003", "Charlie", "Lee", "charlie@example.com", "E", "Hispanic", "Non-binary", "prefer not to say", TS(2023, 12, 1, 10, 15), True, True, D(1988, 7, 14), "locC"),
        ("u001", "uuid-001", "Alice", "Smith", "alice2@example.com", "IL", "White", "Woman", None, TS(2025, 1, 5, 11, 0), True, False, D(1995, 5, 20), None),
        ("u005", "uuid-005", "Elena", "Kim", "elena.k@example.com", "IL", "East Asian,Native American or Alaska Native", "Prefer not to say", None, TS(2024, 6, 20, 13, 20), True, False, D(1998, 9, 12), "locA"),
        ("u006", "uuid-006", "Marcus", "Washington", "marcus.w@example.com", "CL", "Black or African American,Other", "Man,Prefer to self-describe", "genderfluid", TS(2025, 2, 10, 9, 45), True, False, D(2002, 3, 28), "locC"),
        ("u007", "uuid-007", "Sofia", "Rodriguez", "sofia.r@example.com", "E", "Hispanic or Latinx", "Woman", None, TS(2023, 8, 5, 16, 10), True, True, D(1985, 12, 15), "locB"),
        ("u008", "uuid-008", "Test", "User", "testuser123@example.com", "IL", "White", "Man", None, TS(2026, 1, 1, 0, 0), False, False, D(1990, 1, 1), None),
        ("u009", "uuid-009", "Jordan", "Taylor", "jordan.t@example.com", "CL", "Prefer not to say", "Non-binary", None, TS(2023, 3, 15, 11, 30), False, False, D(1997, 8, 7), "locA"),
        ("u005", "uuid-005", "Elena", "Kim", "elena.updated@example.com", "IL", "East Asian,Native American or Alaska Native", "Prefer not to say", None, TS(2026, 2, 20, 10, 15), True, False, D(1998, 9, 12), "locA"),
    ],
    "user_join_record": [
        ("u001", "userjoins", "invite-abc123"),
        ("u002", "userjoins", None),
        ("u003", "userjoins", "invite-edu456"),
        ("u004", "userjoins", "invite-xyz789"),
    ],
    "user_site": [
        ("site1", "Main Academy", "spon001"),
        ("site2", "West Coast Hub", "spon002"),
        ("site3", "Europe Branch", "spon003"),
    ],
    "user_sponsor": [
        ("spon001", "Global Education Foundation"),
        ("spon002", "Tech Learning Partners"),
        ("spon003", "Community Scholars Network"),
        ("spon004", "Future Minds Initiative"),
    ],
    "classroom": [
        ("cls101", "Intro to Data Science", "site1"),
        ("cls202", "Advanced Python", "site2"),
        ("cls303", "Statistics for Everyone", "site1"),
        ("cls404", "Educator Training", "site3"),
    ],
    "classroom_invite_code": [
        ("INV-ABC123", "cls101"),
        ("INV-XYZ789", "cls202"),
        ("INV-EDU456", "cls303"),
        ("INV-TEACH001", "cls404"),
    ],
    "educator_classroom_membership": [
        ("u003", "cls404"),
        ("u003", "cls101"),
    ],
    "educator_invitation_record": [
        ("dana@example.com", "cls202"),
        ("eve@example.com", "cls303"),
    ],
    "learner_classroom_membership": [
        ("u001", "cls101"),
        ("u002", "cls202"),
        ("u001", "cls303"),
        ("u004", "cls101"),
    ],
    "location_core": [
        ("locA", "New York", "New York City, NY, USA", 40.7128, -74.0060, "new-york-ny"),
        ("locB", "London", "London, United Kingdom", 51.5074, -0.1278, "london-uk"),
        ("locC", "San Francisco", "San Francisco, CA, USA", 37.7749, -122.4194, "san-francisco-ca"),
        ("county-ny", "New York County", "New York County, NY, USA", 40.7831, -73.9712, "new-york-county-ny"),
        ("county-sf", "San Francisco County", "San Francisco County, CA, USA", 37.7749, -122.4194, "san-francisco-county-ca"),
        ("state-ny", "New York", "State of New York, USA", 43.2994, -74.2179, "new-york-state"),
        ("state-ca", "California", "State of California, USA", 36.7783, -119.4179, "california-state"),
        ("country-usa", "USA", "United States of America", 37.0902, -95.7129, "united-states"),
        ("country-gbr", "United Kingdom", "United Kingdom of Great Britain and Northern Ireland", 55.3781, -3.4360, "united-kingdom"),
    ],
    "location_address_components": [
        ("locA", "county-ny"), ("locA", "state-ny"), ("locA", "country-usa"),
        ("county-ny", "state-ny"), ("county-ny", "country-usa"),
        ("state-ny", "country-usa"),
        ("locB", "country-gbr"),
        ("locC", "county-sf"), ("locC", "state-ca"), ("locC", "country-usa"),
        ("county-sf", "state-ca"), ("county-sf", "country-usa"),
        ("state-ca", "country-usa"),
    ],
    "location_type": [
        ("locA", 4), ("locB", 4), ("locC", 4),
        ("county-ny", 8), ("county-sf", 8),
        ("state-ny", 7), ("state-ca", 7),
        ("country-usa", 1), ("country-gbr", 1),
    ],
    "sponsor_invite_code": [
        ("invite-abc123", "ABC123", "spon001", "site1"),
        ("invite-edu456", "EDU456", "spon003", "site3"),
        ("invite-xyz789", "XYZ789", "spon002", "site2"),
    ],
}
