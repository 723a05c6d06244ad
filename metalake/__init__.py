"""metalake: software-archive metadata mining on Spark DataFrames."""
