"""tagloom.functions"""
