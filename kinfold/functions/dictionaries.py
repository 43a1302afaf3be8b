"""Word lists of the normalizer and of blocking, and the tables made from them."""

from __future__ import annotations

# Fixed values, which results depend on. A line has `word=replacement` entries, separated by commas, or plain words.

US_STATES_TEXT = """
alabama=al, alaska=ak, arizona=az, arkansas=ar, california=ca, colorado=co, connecticut=ct, delaware=de, district of columbia=dc, washington dc=dc
florida=fl, georgia=ga, hawaii=hi, idaho=id, illinois=il, indiana=in, iowa=ia, kansas=ks, kentucky=ky, louisiana=la, maine=me, maryland=md
massachusetts=ma, michigan=mi, minnesota=mn, mississippi=ms, missouri=mo, montana=mt, nebraska=ne, nevada=nv, new hampshire=nh, new jersey=nj
new mexico=nm, new york=ny, north carolina=nc, north dakota=nd, ohio=oh, oklahoma=ok, oregon=or, pennsylvania=pa, rhode island=ri
south carolina=sc, south dakota=sd, tennessee=tn, texas=tx, utah=ut, vermont=vt, virginia=va, washington=wa, west virginia=wv, wisconsin=wi
wyoming=wy, puerto rico=pr
"""
INDIA_STATES_TEXT = """
andhra pradesh=ap, arunachal pradesh=ar, assam=as, bihar=br, chhattisgarh=cg, chattisgarh=cg, ct=cg, goa=ga, gujarat=gj, haryana=hr
himachal pradesh=hp, jharkhand=jh, karnataka=ka, kerala=kl, madhya pradesh=mp, maharashtra=mh, manipur=mn, meghalaya=ml, mizoram=mz
nagaland=nl, odisha=od, orissa=od, or=od, punjab=pb, rajasthan=rj, sikkim=sk, tamil nadu=tn, tamilnadu=tn, telangana=tg, ts=tg, tripura=tr
uttar pradesh=up, uttarakhand=uk, uttaranchal=uk, ua=uk, west bengal=wb, delhi=dl, nct of delhi=dl, nct delhi=dl, jammu and kashmir=jk
jammu kashmir=jk, ladakh=la, puducherry=py, pondicherry=py, chandigarh=ch, andaman and nicobar islands=an, andaman and nicobar=an
dadra and nagar haveli and daman and diu=dn, dadra and nagar haveli=dn, daman and diu=dd, lakshadweep=ld
"""
NAME_ABBREVIATIONS_TEXT = """
pvt=private, pvte=private, prv=private, pvt.=private, ltd=limited, ltda=limited, lmtd=limited, ltd.=limited, incorporated=inc, incorporation=inc
corp=corporation, corpn=corporation, co=company, cos=company, intl=international, natl=national, mfg=manufacturing, svcs=services, svc=service
mgmt=management, assoc=associates, assocs=associates, bros=brothers, engg=engineering, grp=group, hldgs=holdings, inds=industries
ent=enterprises, entp=enterprises, tech=technology, techs=technologies, tradg=trading, praivet=private, praibhet=private, prayivet=private
limitted=limited, kampani=company, kanpani=company
"""
NAME_STOP_TEXT = """
private, limited, inc, corporation, company, llc, llp, pllc, plc, lp, pc, pa, the, and, of, sarl, sas, sasu, sa, eurl, sci, snc, gmbh, ag, bv, nv, pty
"""
ADDRESS_COMMON_TEXT = """
rd=road, ave=avenue, av=avenue, avn=avenue, aven=avenue, blvd=boulevard, boul=boulevard, bd=boulevard, dr=drive, drv=drive, ln=lane, cir=circle
circ=circle, crcl=circle, ct=court, pl=place, pkwy=parkway, pky=parkway, hwy=highway, sq=square, ter=terrace, terr=terrace, trl=trail
cres=crescent, expy=expressway, fwy=freeway, tpke=turnpike, hts=heights, jct=junction, xing=crossing, ste=suite, apt=apartment, apts=apartment
appts=apartment, aptmt=apartment, aptmts=apartment, apartments=apartment, bldg=building, bld=building, flr=floor, fl=floor, rm=room
"""
ADDRESS_US_TEXT = """
st=street, str=street, mt=mount, ft=fort, n=north, s=south, e=east, w=west, ne=northeast, nw=northwest, se=southeast, sw=southwest
"""
ADDRESS_INDIA_TEXT = """
st=street, str=street, opp=opposite, opps=opposite, nr=near, mkt=market, stn=station, clny=colony, col=colony, sec=sector, sect=sector, ph=phase
vill=village, vil=village, dist=district, distt=district, tal=taluka, tq=taluka, taluk=taluka, mg=mahatma gandhi, bangalore=bengaluru
bombay=mumbai, madras=chennai, calcutta=kolkata, trivandrum=thiruvananthapuram, poona=pune, baroda=vadodara, mysore=mysuru, gurgaon=gurugram
cochin=kochi, vizag=visakhapatnam, benares=varanasi, banaras=varanasi, calicut=kozhikode, mangalore=mangaluru, belgaum=belagavi
cuddapah=kadapa, allahabad=prayagraj, trichy=tiruchirappalli
"""
ADDRESS_FRANCE_TEXT = """
st=saint, ste=sainte, bd=boulevard, bld=boulevard, ch=chemin, chem=chemin, rte=route, imp=impasse, all=allee, qu=quai, fbg=faubourg, crs=cours
pte=porte, res=residence
"""
ADDRESS_STOP_TEXT = """
no, hno, nos, number, num, na, nil, null, none, unknown, cedex
"""
STREET_TEXT = """
street, road, avenue, boulevard, drive, lane, circle, court, place, parkway, highway, square, terrace, trail, crescent, expressway, freeway
turnpike, way, rue, chemin, route, impasse, allee, quai, cours, marg, nagar
"""
GENERIC_TEXT = """
street, road, avenue, boulevard, drive, lane, circle, court, place, parkway, highway, square, terrace, trail, crescent, floor, flat, near
opposite, apartment, building, suite, unit, room, house, city, district, village, taluka, nagar, colony, sector, phase, main, cross, block
plot, shop, north, south, east, west, the, and, rue, chemin, route, saint, des, del, office, post, market, station, gali
"""
#: Unicode letter names of Indic scripts and their romanisation where it isn't the name itself.
INDIC_VOWELS_TEXT = """
A=a, AA=a, I=i, II=i, U=u, UU=u, E=e, EE=e, AI=ai, O=o, OO=o, AU=au, VOCALIC R=ri, VOCALIC RR=ri, VOCALIC L=li, SHORT E=e, SHORT O=o, CANDRA E=e, CANDRA O=o
"""
INDIC_CONSONANTS_TEXT = """
TTA=t, TTHA=th, DDA=d, DDHA=dh, NNA=n, SSA=sh, SHA=sh, LLA=l, RRA=r, NNNA=n, LLLA=l, NGA=n, NYA=n, CA=ch, CHA=chh
"""


def _entries(text: str) -> list[str]:
    return [e.strip() for line in text.strip().splitlines() for e in line.split(",") if e.strip()]


def _table(text: str) -> dict[str, str]:
    return dict(e.split("=", 1) for e in _entries(text))


NAME_ABBREVIATIONS = _table(NAME_ABBREVIATIONS_TEXT)
NAME_STOP = _entries(NAME_STOP_TEXT)
ADDRESS_STOP = _entries(ADDRESS_STOP_TEXT)
STREET = _entries(STREET_TEXT)
GENERIC = _entries(GENERIC_TEXT)
INDIC_VOWELS, INDIC_CONSONANTS = _table(INDIC_VOWELS_TEXT), _table(INDIC_CONSONANTS_TEXT)
#: By country; "" serves the others.
ADDRESS_ABBREVIATIONS = {"": _table(ADDRESS_COMMON_TEXT)} | {
    c: _table(ADDRESS_COMMON_TEXT) | _table(own) for c, own in (("us", ADDRESS_US_TEXT), ("india", ADDRESS_INDIA_TEXT), ("france", ADDRESS_FRANCE_TEXT))
}


def _states(text: str, clipped: bool) -> dict[str, str]:
    """Names to codes; codes stand for themselves, and clipped names lack their last "a", unless these are names already."""
    names = _table(text)
    spare = {n[:-1]: c for n, c in names.items() if clipped and len(n) > 4 and n[-1] == "a"}
    names = spare | names
    return {c: c for c in names.values()} | names


STATES = {"us": _states(US_STATES_TEXT, False), "india": _states(INDIA_STATES_TEXT, True)}
