"""duebook: registers of obligations and their answers, as Spark DataFrame operators."""
