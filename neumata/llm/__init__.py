"""Training-data operators: mixing, filtering, packing, scoring, scanning, de-duplication and sharding.

Each module is one operator with its own general interface; ``registry`` binds the
thin ``opN_*`` queries to the tables of the test data.
"""
