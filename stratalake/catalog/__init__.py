"""The registered queries, their inputs, and the SQL each must agree with."""
