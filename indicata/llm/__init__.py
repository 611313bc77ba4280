"""Operations of a training-data pipeline over document, page and vector tables.

Every operator takes DataFrames and returns DataFrames, reads only the columns it names (other columns, whatever they
are called, neither clash nor matter) and gives nulls, empty texts, very long texts, ties, repeated rows and empty
tables a defined result, stated in its docstring.
"""
