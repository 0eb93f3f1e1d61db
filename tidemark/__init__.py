"""tidemark: a Spark-native engine for serialized-story and entity data.

The package is layered so that nothing below imports anything above it:

* ``session`` / ``sources``  - sessions, table readers and writers, shared scratch space
* ``functions``              - scalar and array expressions (JVM side unless noted)
* ``operators``              - DataFrame -> DataFrame operators
* ``plans``                  - whole queries over the catalogue's tables, with their SQL
* ``streaming``              - Structured Streaming forms
* ``llm``                    - training-data operators; nothing else imports it
"""

__version__ = "0.1.0"
