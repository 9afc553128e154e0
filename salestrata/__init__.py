"""salestrata: layered sales analytics on Spark.

JSON Lines sales events go through three layers: RAW keeps every record as it
arrived, STAGING splits the records into typed clean rows and rejects with a
reason, and ANALYTICS holds the fact table the reports read.  Everything is a
DataFrame expression; there is no Python UDF.
"""

from salestrata.profiles import DOCUMENTED, LITERAL, Profile, resolve_profile

__all__ = ["DOCUMENTED", "LITERAL", "Profile", "resolve_profile"]
