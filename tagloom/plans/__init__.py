"""tagloom.plans"""
