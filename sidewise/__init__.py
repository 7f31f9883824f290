"""sidewise: two-sided event analytics expressed as PySpark DataFrame plans.

An *event* (a match) has a home and an away side.  The package takes raw JSON
documents to typed tables, dimensional facts and per-side rollups using only
DataFrame transformations, so every step stays lazy until a sink or a quality
gate asks for rows.
"""

__version__ = "0.1.0"
