"""Tables, change feeds, export files and control tables as DataFrames."""
