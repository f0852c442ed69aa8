"""Column functions and their UDF flavours."""
