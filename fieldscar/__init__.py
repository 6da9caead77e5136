"""fieldscar: crop-damage dataset building and auditing as Spark DataFrame operators."""
