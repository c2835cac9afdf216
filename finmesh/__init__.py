"""finmesh: Spark-native ETL and analytics for development-finance records.

Landed JSON pages of projects and documents are flattened into normalised
lookup, fact and bridge tables, audited for integrity, and summarised in
marts (project/document timelines, sector allocation, sector coverage, top
sectors by country).  Every operator is a plain ``DataFrame -> DataFrame``
function made of Spark SQL expressions; nothing is collected to the driver.
"""

__version__ = "0.1.0"
