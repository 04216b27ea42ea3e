"""dimloom — person-profile analytics expressed as Spark DataFrame plans.

Raw person, place and membership tables go in; three tables come out:

* ``locations_clean``   one resolved city / county / state / country per place
* ``user_attributions`` every route that links a person to a classroom, site, sponsor
* ``dim_users``         one deterministic profile row per person

plus declarative data-quality checks and a table profile.  Everything is a
Column expression or a DataFrame operator, so Catalyst plans it and the work
runs on the executors; no Python UDF is used anywhere.
"""

__version__ = "0.1.0"
