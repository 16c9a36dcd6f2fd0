"""galaxia: a Spark-native medallion (bronze / silver / gold) library.

Raw order, item, payment, review, customer, product, seller and geolocation
tables are cleaned by one shared set of column rules, modelled as a galaxy
schema with stable surrogate keys, kept current by watermark batches or a file
stream with keyed upserts, audited, and reported on -- all as DataFrame / Spark
SQL plans.
"""

__version__ = "0.1.0"
