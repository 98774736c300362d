"""larder: franchise analytics as Spark DataFrame operations.

``sources``    reading, writing and locating tables, and the driver's tables
               seen as franchise entities;
``catalog``    the relational schema: columns, keys, references, rules;
``functions``  column expressions (dates, keys, money, recipes);
``operators``  DataFrame -> DataFrame computations;
``plans``      named queries with their cross-checking SQL, and the loaders.
"""
